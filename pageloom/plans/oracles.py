"""Plain SQL for every query, over the given tables.

Written on its own, not from the Spark code: URL parts come from one regular
expression, walks are unrolled level by level, leader groups are a sequential
scan.  ``with_views`` puts the views a statement uses in front of it.
"""

from __future__ import annotations

import re

from pageloom.functions import fixed
from pageloom.plans.views import LIMITS, SOCIAL, SUFFIXES, WALK_DEPTH

SITE = "concat('https://www.site', page_id % 4, '.test')"
T = fixed.SIMILARITY_THRESHOLD


def _values(items) -> str:
    return ", ".join(f"('{i}')" for i in items)


def _strings(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


VIEWS: dict[str, str] = {
    "suffixes": f"SELECT * FROM (VALUES {_values(SUFFIXES)}) AS v(suffix)",
    "social": f"SELECT * FROM (VALUES {_values(SOCIAL)}) AS v(domain)",
    "site_pages": f"""
        SELECT page_id, page_id % 4 AS site_no, page_id // 4 AS k, {SITE} AS site,
               concat({SITE}, '/en/', page_id // 4) AS url,
               TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id) AS ts
        FROM pages""",
    "site_links": """
        SELECT p.page_id, v.pos,
          CASE v.pos
            WHEN 0 THEN concat('/en/', 3 * p.k + 1)
            WHEN 1 THEN concat('/EN/', 3 * p.k + 2, '/')
            WHEN 2 THEN concat(p.site, '/en/', 3 * p.k + 3, '?page=2#top')
            WHEN 3 THEN concat(upper(p.site), '/en/', CAST(floor((p.k + 2) / 3) - 1 AS BIGINT))
            WHEN 4 THEN '/img/logo.png'
            WHEN 5 THEN '/login'
            WHEN 6 THEN 'https://other.elsewhere.test/x'
            ELSE '#top' END AS href
        FROM site_pages p CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7)) AS v(pos)""",
    "page_media": """
        SELECT p.page_id, v.pos,
          CASE (p.page_id + v.pos) % 6
            WHEN 0 THEN concat('/static/', p.page_id, '.jpg')
            WHEN 1 THEN concat('//cdn.elsewhere.test/', p.page_id, '.png')
            WHEN 2 THEN concat('thumbs/', p.page_id, '.webp')
            WHEN 3 THEN 'https://www.site0.test/static/shared.jpg'
            WHEN 4 THEN ''
            ELSE concat('../up/', p.page_id, '.jpeg') END AS src
        FROM pages p CROSS JOIN (VALUES (0),(1)) AS v(pos)
        WHERE v.pos < p.page_id % 3""",
    "raw_links": """
        SELECT page_id, url AS page_url, generate_subscripts(hs, 1) - 1 AS pos, unnest(hs) AS href
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages)""",
    "link_forms": """
        SELECT page_id, page_url, pos, v.form,
          CASE v.form
            WHEN 0 THEN href
            WHEN 1 THEN '#top'
            WHEN 2 THEN concat('?z=', pos)
            WHEN 3 THEN concat('..', href, '?p=1')
            WHEN 4 THEN concat('HTTPS://X.com', href, '?B=2&a=1&b=9&page=3&c=&a=0&e=', href[2:], '#t')
            WHEN 5 THEN concat('/img', href)
            WHEN 6 THEN concat(href, '.JPG')
            WHEN 7 THEN concat('mailto:me@', href[2:])
            WHEN 8 THEN concat('http://y.com', href, ';P=1?q=a%20b+c&Q=%zz~*&s=/')
            ELSE concat('.', href, '/./x/../y//') END AS href
        FROM raw_links CROSS JOIN (SELECT unnest(range(10)) AS form) AS v""",
    "seeds": "SELECT site_no AS ord, url AS domain FROM site_pages WHERE k = 0",
    "messy_seeds": """
        SELECT page_id AS ord, CASE page_id % 5 WHEN 0 THEN NULL
          WHEN 1 THEN concat(' ', chr(9), url, ' ', chr(10))
          WHEN 2 THEN 'https://www.site0.test/en/0' ELSE url END AS domain FROM pages""",
    "task_log": """
        SELECT concat('task-', event_id, '-', user_id) AS task_id,
          concat('https://www.site', user_id % 4, '.test/en/section/subsection/', event_id) AS url,
          CASE event_type WHEN 'view' THEN 'QUEUED' WHEN 'click' THEN 'IN_PROGRESS' WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
          value AS memory_mb, value * 2 AS peak_mb, ts AS start_time,
          CASE WHEN event_type IN ('view','click') THEN NULL ELSE ts END AS end_time
        FROM events""",
    "attempt_log": """
        SELECT concat(user_id, '-', (rn - 1) // 3) AS req_id,
          concat('https://www.site', user_id % 4, '.test/static/', user_id, '.jpg') AS url,
          CAST((rn - 1) % 3 AS INT) AS attempt, ts,
          CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 429 WHEN 'purchase' THEN 503 END AS status,
          CASE event_type WHEN 'error' THEN 'timeout' WHEN 'signup' THEN 'connect' END AS error
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) e""",
    "img_items": """
        SELECT vec_id * 3 + c AS ord,
          list_transform(embedding, lambda x, i: x::DOUBLE + (CASE WHEN vec_id % 5 = 0 THEN 0.0 ELSE 0.01::DOUBLE * c END)::DOUBLE
            * (CASE WHEN (i - 1 + vec_id) % 7 = 0 THEN 1 ELSE -1 END)) AS px,
          1000 + (vec_id * 7919 + c * 104729) % 50000 AS size_bytes,
          100 + (vec_id * 31 + c * 17) % 600 AS width, 80 + (vec_id * 13 + c * 29) % 500 AS height
        FROM embeddings CROSS JOIN (VALUES (0),(1),(2)) AS v(c)""",
    "faces": """
        SELECT concat('img/', i, '.jpg') AS image_path,
          CASE WHEN i % 5 = 0 THEN [] ELSE fs END AS faces
        FROM (SELECT vec_id // 3 AS i, list(embedding ORDER BY vec_id) AS fs FROM embeddings GROUP BY 1)""",
    "walked": """
        SELECT site, url, depth, [k::INT] AS trail, page_id, ts
        FROM (SELECT *, length(k::VARCHAR) - 1 AS depth FROM site_pages)
        UNION ALL
        SELECT site, url, length(k::VARCHAR) AS depth, [k::INT], page_id, ts FROM site_pages WHERE k % 50 = 0""",
    "page_links": "SELECT l.*, p.url AS page_url, p.site FROM site_links l JOIN site_pages p USING (page_id)",
    "section_links": """
        SELECT root AS domain, page_id * 1000 + pos AS ord,
          CASE pos WHEN 3 THEN 'https://not.other.test/x' WHEN 5 THEN href
            ELSE concat(root, CASE WHEN page_id % 3 = 0 THEN upper(nested) ELSE nested END) END AS href
        FROM (SELECT *, regexp_extract(page_url, '^[a-z]+://[^/]+') AS root,
                CASE WHEN length(href) > 5 THEN concat('/', href[2:2], '/', href[2:]) ELSE href END AS nested
              FROM raw_links)""",
}

# -- URLs ------------------------------------------------------------------

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _parsed(text: str) -> str:
    return f"regexp_extract({text}, '{_URL}', ['scheme', 'netloc', 'path', 'query', 'fragment'])"


def _params(scheme: str, path: str) -> str:
    return (f"CASE WHEN lower({scheme}) IN ({_strings(fixed.PARAM_SCHEMES)}) "
            f"THEN regexp_extract({path}, '^(?:.*/)?[^/;]*;([^/]*)$', 1) ELSE '' END")


def _path(scheme: str, path: str) -> str:
    return (f"CASE WHEN lower({scheme}) IN ({_strings(fixed.PARAM_SCHEMES)}) "
            rf"THEN regexp_replace({path}, '^((?:.*/)?[^/;]*);[^/]*$', '\1') ELSE {path} END")


def _dots(path: str) -> str:
    """Dot segments by a left fold over text."""
    return (
        f"list_reduce(string_split({path}, '/'), lambda acc, s: CASE WHEN s = '..' THEN regexp_replace(acc, '/[^/]*$', '') "
        f"WHEN s = '.' THEN acc ELSE concat(acc, '/', s) END) "
        f"|| CASE WHEN regexp_matches({path}, '/[.]{{1,2}}$') THEN '/' ELSE '' END")


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _query(q: str) -> str:
    pairs = (f"list_transform(list_filter(string_split({q}, '&'), lambda t: regexp_matches(t, '^[^=]*=.')), "
             f"lambda t: {{'k': {_dec('string_split(t, chr(61))[1]')}, 'v': {_dec('t[strpos(t, chr(61)) + 1:]')}}})")
    return f"""(
        SELECT coalesce(string_agg(concat({_enc('low')}, '=', {_enc('v')}), '&' ORDER BY place, v), '')
        FROM (
          SELECT k, v, low, place, last_key FROM (
            SELECT u.k, u.v, lower(u.k) AS low,
              min(u.i) OVER (PARTITION BY lower(u.k)) AS place,
              last_value(u.k) OVER (PARTITION BY lower(u.k) ORDER BY u.first_i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_key
            FROM (SELECT s.k, s.v, i, min(i) OVER (PARTITION BY s.k) AS first_i
                  FROM (SELECT unnest({pairs}) AS s, generate_subscripts({pairs}, 1) AS i)) u)
        ) z WHERE k = last_key AND low <> 'page')"""


def normal_form(source: str, name: str) -> dict[str, str]:
    """Views ending in ``name`` = ``source`` rows plus ``joined`` (absolute) and ``url`` (normal form)."""
    media = "|".join(e[1:] for e in fixed.MEDIA_EXTENSIONS)
    words = _strings(fixed.PROHIBITED_SEGMENTS)
    return {
        f"{name}_parts": f"SELECT *, row_number() OVER () AS rid, {_parsed('href')} AS u, {_parsed('page_url')} AS b FROM {source}",
        f"{name}_full": f"""
            SELECT *, CASE
              WHEN u.netloc <> '' THEN {{'scheme': u.scheme, 'netloc': u.netloc, 'path': {_path('u.scheme', 'u.path')},
                'params': {_params('u.scheme', 'u.path')}, 'query': u.query}}
              WHEN u.path = '' THEN {{'scheme': b.scheme, 'netloc': b.netloc, 'path': b.path, 'params': '', 'query': b.query}}
              ELSE {{'scheme': b.scheme, 'netloc': b.netloc, 'path': {_dots("CASE WHEN u.path[1] = '/' THEN pp ELSE regexp_replace(concat(regexp_replace(b.path, '[^/]*$', ''), pp), '/+', '/', 'g') END")},
                'params': CASE WHEN u.scheme = 'mailto' THEN {_params("''", 'u.path')} ELSE '' END, 'query': ''}} END AS f
            FROM (SELECT *, CASE WHEN u.scheme = 'mailto' THEN {_path("''", 'u.path')} ELSE {_path('u.scheme', 'u.path')} END AS pp FROM {name}_parts)""",
        name: f"""
            SELECT *, concat(f.scheme, '://', f.netloc, f.path, CASE WHEN f.params <> '' THEN concat(';', f.params) ELSE '' END,
                     CASE WHEN f.query <> '' THEN concat('?', f.query) ELSE '' END) AS joined,
              CASE WHEN regexp_matches(lower(f.path), '[.]({media})$')
                     OR list_has_any(string_split(lower(f.path), '/'), [{words}]) THEN NULL
                ELSE rtrim(concat(lower(f.scheme), '://', lower(f.netloc), lower(f.path),
                     CASE WHEN f.params <> '' THEN concat(';', f.params) ELSE '' END,
                     CASE WHEN cq <> '' THEN concat('?', cq) ELSE '' END), '/') END AS url
            FROM (SELECT *, CASE WHEN f.query = '' THEN '' ELSE {_query('f.query')} END AS cq FROM {name}_full)""",
    }


VIEWS.update(normal_form("link_forms", "forms_normal"))
VIEWS.update(normal_form("raw_links", "raw_normal"))
VIEWS.update(normal_form("page_links", "links_normal"))


def host_of(url: str) -> str:
    return f"regexp_replace(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '^.*@|:.*$', '', 'g')"


def domain_of(host: str) -> str:
    """Main domain by trying the suffixes from the longest on."""
    arms = " ".join(
        f"WHEN lower({host}) = '{s}' THEN concat('.', {host}) "
        f"WHEN lower({host}) LIKE '%.{s}' THEN regexp_extract({host}, '([^.]*[.][^.]+{'[.][^.]+' * s.count('.')})$', 1)"
        for s in sorted(SUFFIXES, key=lambda s: (-s.count("."), s)))
    return f"CASE {arms} ELSE {host} END"


VIEWS["edges"] = f"""
    SELECT page_id, site, pos, url FROM links_normal
    WHERE url IS NOT NULL AND url <> '' AND {domain_of(host_of('url'))} = {domain_of(host_of('page_url'))}"""

VIEWS["found"] = """
    SELECT site, url, [page_id::INT, pos::INT] AS trail FROM links_normal WHERE url IS NOT NULL AND url <> ''"""


def image_url(src: str, page: str) -> str:
    folder = f"regexp_replace({page}, '[^/]*$', '')"
    up = f"regexp_replace({folder}, '[^/]*/$', '')"
    return f"""CASE WHEN {src} LIKE '//%' THEN concat('https:', {src})
        WHEN {src} LIKE '/%' THEN concat(regexp_extract({page}, '^https?://[^/]*'), {src})
        WHEN {src} LIKE 'http%' THEN {src}
        WHEN {src} LIKE '../%' THEN concat({up}, {src}[4:]) ELSE concat({folder}, {src}) END"""


VIEWS["walked_images"] = f"""
    SELECT w.site, {image_url('m.src', 'w.url')} AS image_url, w.url AS page_url, w.ts, w.depth, w.trail, m.pos
    FROM walked w JOIN page_media m USING (page_id) WHERE m.src <> ''"""


def report_view(crawled: str, images: str) -> str:
    return f"""
    SELECT c.site, c.depth, c.url AS page_url, i.image_url, coalesce(i.ts, c.ts) AS ts, c.trail,
      i.depth AS image_depth, i.trail AS image_trail, i.pos
    FROM {crawled} c LEFT JOIN {images} i ON i.site = c.site AND i.page_url = c.url"""


VIEWS["report"] = report_view("walked", "walked_images")


def manifest_view(report: str) -> str:
    return f"""
    SELECT site, depth, row_num, image_url AS url, concat(row_num, '_d', depth, '.jpg') AS filename,
      concat('{fixed.BASE_FOLDER}/', replace(replace(replace(site, '%', '%25'), '/', '%2F'), ':', '%3A'), '/Depth Level ', depth) AS folder
    FROM (SELECT *, 1 + row_number() OVER (PARTITION BY site, depth ORDER BY trail, image_depth NULLS FIRST, image_trail NULLS FIRST, pos NULLS FIRST) AS row_num FROM {report})
    WHERE image_url IS NOT NULL AND image_url <> ''"""


VIEWS["manifest"] = manifest_view("report")

# -- sections --------------------------------------------------------------

VIEWS["section_first"] = f"""
    SELECT domain, lower(href) AS href_lower, arg_min(href, ord) AS href FROM section_links
    WHERE contains(lower(regexp_extract(href, '^[A-Za-z]+://([^/?#]*)', 1)), {domain_of(host_of('domain'))})
    GROUP BY ALL"""
VIEWS["section_named"] = """
    SELECT *, CASE WHEN seg = '' THEN 'root' ELSE seg END AS section
    FROM (SELECT *, string_split(trim(regexp_extract(href_lower, '^[a-z]+://[^/]*([^?#;]*)', 1), '/'), '/')[1] AS seg FROM section_first)"""
VIEWS["section_folded"] = """
    SELECT domain, CASE WHEN count(*) OVER (PARTITION BY domain, section) = 1 THEN 'root' ELSE section END AS section, href
    FROM section_named"""

# -- the walk, level by level ----------------------------------------------


def walk_views(prefix: str, limits, depth: int) -> dict[str, str]:
    """Unrolled breadth-first walk: ``{prefix}_crawled``, ``_discovered``, ``_frontier``."""
    out = {f"{prefix}_q0": "SELECT domain AS site, domain AS url, []::INT[] AS trail FROM seeds"}
    for d in range(depth + 1):
        cut = limits[d] if d < len(limits) else None
        taken = (f"SELECT * FROM {prefix}_q{d} QUALIFY row_number() OVER (PARTITION BY site ORDER BY trail) <= {cut}"
                 if cut else f"SELECT * FROM {prefix}_q{d}")
        out[f"{prefix}_c{d}"] = f"SELECT q.site, q.url, q.trail, p.page_id, p.ts FROM ({taken}) q JOIN site_pages p ON p.url = q.url"
        seen = "".join(f" AND NOT EXISTS (SELECT 1 FROM {prefix}_q{e} o WHERE o.site = c.site AND o.url = e.url)" for e in range(1, d + 1))
        out[f"{prefix}_q{d + 1}"] = f"""
            SELECT c.site, e.url, min(list_append(c.trail, e.pos::INT)) AS trail
            FROM {prefix}_c{d} c JOIN edges e USING (page_id) WHERE true{seen} GROUP BY ALL"""
    each = range(depth + 1)
    out[f"{prefix}_crawled"] = " UNION ALL ".join(f"SELECT *, {d} AS depth FROM {prefix}_c{d}" for d in each)
    out[f"{prefix}_discovered"] = " UNION ALL ".join(f"SELECT *, {d + 1} AS depth FROM {prefix}_q{d + 1}" for d in each)
    out[f"{prefix}_frontier"] = " UNION ALL ".join(f"SELECT *, {d} AS depth FROM {prefix}_q{d}" for d in each)
    return out


VIEWS.update(walk_views("walk", [], WALK_DEPTH))
VIEWS.update(walk_views("cut", LIMITS, 3))
VIEWS["walk_images"] = f"""
    SELECT w.site, {image_url('m.src', 'w.url')} AS image_url, w.url AS page_url, w.ts, w.depth, w.trail, m.pos
    FROM walk_crawled w JOIN page_media m USING (page_id) WHERE m.src <> ''"""
VIEWS["walk_report"] = report_view("walk_crawled", "walk_images")

# -- images ----------------------------------------------------------------

_HEX = ("array_to_string(list_transform(range(16), lambda q: substr('0123456789abcdef', "
        "1 + 8 * bits[4*q+1] + 4 * bits[4*q+2] + 2 * bits[4*q+3] + bits[4*q+4], 1)), '')")
VIEWS["ahashes"] = f"""
    SELECT ord, {_HEX} AS ahash FROM (
      SELECT ord, list_transform(px, lambda x: CASE WHEN x > m THEN 1 ELSE 0 END) AS bits
      FROM (SELECT ord, px, list_avg(px) AS m FROM img_items))"""
VIEWS["phashes"] = f"""
    SELECT ord, {_HEX} AS phash FROM (
      SELECT ord, list_transform(cs, lambda x: CASE WHEN x > m THEN 1 ELSE 0 END) AS bits
      FROM (SELECT ord, cs, list_median(cs) AS m FROM (
        SELECT ord, list_transform(range(64), lambda f: list_sum(list_transform(range(64), lambda n:
          px[n + 1] * 4 * cos(pi() * (f // 8) * (2 * (n // 8) + 1) / 16) * cos(pi() * (f % 8) * (2 * (n % 8) + 1) / 16)))) AS cs
        FROM img_items)))"""
VIEWS["items"] = """
    SELECT i.ord, phash, ahash, size_bytes, width, height FROM img_items i JOIN ahashes USING (ord) JOIN phashes USING (ord)"""


def char_distance(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, 17), lambda c: CASE WHEN substr({a}, c, 1) <> substr({b}, c, 1) THEN 1 ELSE 0 END))"


# one item after the other, with the list of leaders so far
VIEWS["scan"] = f"""
    SELECT 0::BIGINT AS n, 0::BIGINT AS ord, NULL::BIGINT AS leader_ord, []::STRUCT(o BIGINT, p VARCHAR, a VARCHAR)[] AS leaders
    UNION ALL
    SELECT n, ord, coalesce(hit.o, ord), CASE WHEN hit IS NULL THEN list_append(leaders, {{'o': ord, 'p': phash, 'a': ahash}}) ELSE leaders END
    FROM (SELECT i.n, i.ord, i.phash, i.ahash, s.leaders,
            list_filter(s.leaders, lambda l: {char_distance('l.p', 'i.phash')} <= {T} AND {char_distance('l.a', 'i.ahash')} <= {T})[1] AS hit
          FROM scan s JOIN (SELECT *, row_number() OVER (ORDER BY ord) AS n FROM items) i ON i.n = s.n + 1)"""
VIEWS["grouped"] = """
    SELECT i.*, s.leader_ord, dense_rank() OVER (ORDER BY s.leader_ord) AS group_no
    FROM items i JOIN (SELECT ord, leader_ord FROM scan WHERE n > 0) s USING (ord)"""
VIEWS["acted"] = """
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY group_no ORDER BY size_bytes DESC, ord) = 1 THEN 'Retained' ELSE 'Deleted' END AS action
    FROM grouped"""
VIEWS["ranked"] = """
    SELECT *, row_number() OVER (PARTITION BY group_no ORDER BY action DESC, ord) AS rank FROM acted"""

VIEWS["outcomes"] = """
    SELECT req_id, url,
      CASE WHEN e IS NULL THEN 'exhausted' WHEN s = 200 THEN 'saved' ELSE 'stopped' END AS outcome,
      CAST(coalesce(e, m) + 1 AS INT) AS n_attempts
    FROM (SELECT req_id, url, max(attempt) AS m,
            min(attempt) FILTER (WHERE status NOT IN (429) OR error = 'connect') AS e,
            arg_min(coalesce(status, 0), attempt) FILTER (WHERE status NOT IN (429) OR error = 'connect') AS s
          FROM attempt_log WHERE attempt < 3 GROUP BY ALL)"""


def with_views(body: str) -> str:
    """``body`` with the views it needs, each after the ones it reads."""
    placed: dict[str, str] = {}

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in placed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                if name != "scan":
                    need(VIEWS[name])
                else:
                    need(VIEWS[name].replace("FROM scan ", ""))
                placed[name] = VIEWS[name]

    need(body)
    if not placed:
        return body
    recursive = "RECURSIVE " if "scan" in placed else ""
    views = ",\n".join(f"{n} AS {'' if n == 'scan' else 'MATERIALIZED '}({q})" for n, q in placed.items())
    return f"WITH {recursive}{views}\n{body}"
