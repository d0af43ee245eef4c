"""URL rules as native column expressions.

The rules follow the generic URL syntax (RFC 3986) as widely deployed
libraries apply it.  Everything here is built from string built-ins, so it
runs inside the JVM; array lambdas are reached only by URLs that have a query
or dot segments.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed
from pageloom.functions.staging import Lookup, Step, as_column, with_steps

_LEADING_JUNK = "".join(chr(c) for c in range(0x21))


def _clean(url: Column) -> Column:
    """Drop leading control characters and spaces, and any tab or line break."""
    return F.translate(F.ltrim(url, F.lit(_LEADING_JUNK)), "\t\r\n", "")


def _tail(text: Column, taken: Column | int) -> Column:
    """What follows the first ``taken`` characters."""
    return F.substr(text, taken + F.lit(1))


@cache
def _parse_steps(p: str, source: str) -> list[Step]:
    """Steps splitting ``source`` into ``{p}scheme`` .. ``{p}fragment``."""

    def has_authority(g: Lookup) -> Column:
        return F.startswith(g(f"{p}rest"), F.lit("//"))

    def last_segment(g: Lookup) -> Column:
        return F.substring_index(g(f"{p}full_path"), "/", -1)

    def params(g: Lookup) -> Column:
        last = last_segment(g)
        name = F.substring_index(last, ";", 1)
        return F.when(
            g(f"{p}scheme").isin(*fixed.PARAM_SCHEMES) & F.contains(last, F.lit(";")),
            _tail(last, F.length(name)),
        )

    def path(g: Lookup) -> Column:
        # params is null without ';' and starts with it otherwise
        whole = g(f"{p}full_path")
        cut = F.length(whole) - F.length(g(f"{p}semi"))
        return F.when(g(f"{p}semi").isNull(), whole).otherwise(F.substr(whole, F.lit(1), cut))

    return [
        (f"{p}text", lambda g: _clean(g(source))),
        (f"{p}nofrag", lambda g: F.substring_index(g(f"{p}text"), "#", 1)),
        (f"{p}fragment", lambda g: _tail(g(f"{p}text"), F.length(g(f"{p}nofrag")) + 1)),
        (f"{p}head", lambda g: F.substring_index(g(f"{p}nofrag"), "?", 1)),
        (f"{p}query", lambda g: _tail(g(f"{p}nofrag"), F.length(g(f"{p}head")) + 1)),
        (f"{p}scheme", lambda g: F.lower(F.regexp_extract(g(f"{p}head"), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))),
        (f"{p}rest", lambda g: F.when(g(f"{p}scheme") == "", g(f"{p}head")).otherwise(
            _tail(g(f"{p}head"), F.length(g(f"{p}scheme")) + 1))),
        (f"{p}netloc", lambda g: F.when(
            has_authority(g), F.substring_index(_tail(g(f"{p}rest"), F.lit(2)), "/", 1)).otherwise(F.lit(""))),
        (f"{p}full_path", lambda g: F.when(
            has_authority(g), _tail(g(f"{p}rest"), F.length(g(f"{p}netloc")) + 2)).otherwise(g(f"{p}rest"))),
        (f"{p}semi", params),
        (f"{p}path", path),
        (f"{p}params", lambda g: F.coalesce(_tail(g(f"{p}semi"), F.lit(1)), F.lit(""))),
    ]


def _bad_host(netloc: Column) -> Column:
    """Hosts a strict parser refuses: broken brackets or look-alike delimiters."""
    after_user = F.substring_index(netloc, "@", -1)
    brackets = F.contains(netloc, F.lit("[")) | F.contains(netloc, F.lit("]"))
    ip_literal = after_user.rlike(r"^\[(?:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*(?:%.+)?|v[0-9A-Fa-f]+\..+)\](?::.*)?$")
    return (brackets & ~ip_literal) | netloc.rlike(f"[{fixed.CONFUSABLE_HOST_CHARS}]")


def _fold_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments."""
    segments = F.split(path, "/", -1)

    def step(done: Column, seg: Column) -> Column:
        return (
            F.when(seg == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(seg == ".", done)
            .otherwise(F.concat(done, F.array(seg)))
        )

    folded = F.aggregate(segments, F.array().cast("array<string>"), step)
    open_end = path.rlike(r"(?:^|/)\.{1,2}$")
    closed = F.when(open_end, F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    joined = F.array_join(closed, "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def _merge_paths(base: Column, path: Column) -> Column:
    """Place a non-empty reference path on top of a base path."""
    folder = F.when(base == "", F.lit("/")).otherwise(F.regexp_replace(base, "[^/]*$", ""))
    merged = F.when(F.startswith(path, F.lit("/")), path).otherwise(
        F.regexp_replace(F.concat(folder, path), "/{2,}", "/"))
    return F.when(merged.rlike(r"(?:^|/)\.{1,2}(?:/|$)"), _fold_dots(merged)).otherwise(
        F.when(merged == "", F.lit("/")).otherwise(merged))


def _join_steps(base: str, ref: str, out: str) -> list[Step]:
    """Resolve parsed ``ref`` against parsed ``base`` (prefixes) into ``out``."""

    def foreign(g: Lookup) -> Column:
        own = (g(f"{ref}scheme") != "") & (g(f"{ref}scheme") != g(f"{base}scheme"))
        no_base = (g(f"{base}text") == "") | ~g(f"{base}scheme").isin(*fixed.RELATIVE_SCHEMES)
        return own | no_base

    def pick(part: str, own_authority, same_page, moved):
        def build(g: Lookup) -> Column:
            return (
                F.when(g(f"{out}mode") == "foreign", g(f"{ref}{part}"))
                .when(g(f"{out}mode") == "authority", own_authority(g))
                .when(g(f"{out}mode") == "same", same_page(g))
                .otherwise(moved(g))
            )
        return (f"{out}{part}", build)

    def r(part):
        return lambda g: g(f"{ref}{part}")

    def b(part):
        return lambda g: g(f"{base}{part}")

    def query(g: Lookup) -> Column:
        return F.when(g(f"{ref}query") == "", g(f"{base}query")).otherwise(g(f"{ref}query"))

    return [
        (f"{out}mode", lambda g: F.when((g(f"{ref}text") == "") & (g(f"{base}text") != ""), "same")
            .when(foreign(g), "foreign")
            .when(g(f"{ref}netloc") != "", "authority")
            .when((g(f"{ref}path") == "") & (g(f"{ref}params") == ""), "same")
            .otherwise("moved")),
        pick("scheme", b("scheme"), b("scheme"), b("scheme")),
        pick("netloc", r("netloc"), b("netloc"), b("netloc")),
        pick("path", r("path"), b("path"), lambda g: _merge_paths(g(f"{base}path"), g(f"{ref}path"))),
        pick("params", r("params"), b("params"), r("params")),
        pick("query", r("query"), query, r("query")),
        pick("fragment", r("fragment"), r("fragment"), r("fragment")),
    ]


def _compose(scheme: Column, netloc: Column, path: Column, params: Column,
             query: Column, fragment: Column | None = None) -> Column:
    """Put URL parts back together."""
    tail = F.when(params == "", path).otherwise(F.concat(path, F.lit(";"), params))
    slashed = F.when((tail != "") & ~F.startswith(tail, F.lit("/")), F.concat(F.lit("/"), tail)).otherwise(tail)
    needs_authority = F.startswith(tail, F.lit("//")) | (
        (scheme != "") & scheme.isin(*fixed.AUTHORITY_SCHEMES) & ((tail == "") | F.startswith(tail, F.lit("/"))))
    body = (
        F.when(netloc != "", F.concat(F.lit("//"), netloc, slashed))
        .when(needs_authority, F.concat(F.lit("//"), tail))
        .otherwise(tail)
    )
    text = F.when(scheme == "", body).otherwise(F.concat(scheme, F.lit(":"), body))
    text = F.when(query == "", text).otherwise(F.concat(text, F.lit("?"), query))
    if fragment is not None:
        text = F.when(fragment == "", text).otherwise(F.concat(text, F.lit("#"), fragment))
    return text


# -- query strings ---------------------------------------------------------

def form_decode(text: Column) -> Column:
    """Decode ``+`` and ``%XX``; malformed escapes stay as they are."""
    return F.when(
        text.rlike("[%+]"),
        F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")),
    ).otherwise(text)


def form_encode(text: Column) -> Column:
    """Encode for a query string, leaving letters, digits and ``_.-~``."""
    return F.when(text.rlike("^[A-Za-z0-9_.-]*$"), text).otherwise(
        F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")))


def canonical_query(query: Column, drop_params: Iterable[str] = ("page",), sort_keys: bool = False) -> Column:
    """Canonical form of a query string.

    Blank values go, names are lower-cased, ``drop_params`` are removed and the
    values of each name are sorted.  Names keep their order of appearance
    unless ``sort_keys``; of names equal after lower-casing the last one wins.
    """
    dropped = [p.lower() for p in drop_params]

    def pair(text: Column) -> Column:
        name = F.substring_index(text, "=", 1)
        return F.struct(form_decode(name).alias("k"), form_decode(_tail(text, F.length(name) + 1)).alias("v"))

    pairs = F.transform(
        F.filter(F.split(query, "&", -1), lambda t: t.rlike("(?s)^[^=]*=.")), pair)

    def encode(pairs: Column) -> Column:
        names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
        return F.transform(F.array(names), lambda n: encode_names(pairs, n))[0]

    def encode_names(pairs: Column, names: Column) -> Column:
        lowered = F.array_distinct(F.transform(names, F.lower))
        if dropped:
            lowered = F.filter(lowered, lambda k: ~k.isin(*dropped))
        if sort_keys:
            lowered = F.array_sort(lowered)
        return F.array_join(F.transform(lowered, lambda k: encode_one(pairs, names, k)), "&")

    def encode_one(pairs: Column, names: Column, low: Column) -> Column:
        winner = F.element_at(F.filter(names, lambda n: F.lower(n) == low), -1)
        values = F.transform(
            F.array(winner), lambda w: F.transform(F.filter(pairs, lambda p: p["k"] == w), lambda p: p["v"]))[0]
        return F.array_join(
            F.transform(F.array_sort(values), lambda v: F.concat(form_encode(low), F.lit("="), form_encode(v))), "&")

    return F.when(query == "", F.lit("")).otherwise(F.transform(F.array(pairs), encode)[0])


# -- link filters ----------------------------------------------------------

def is_media_path(path: Column) -> Column:
    """True when the lower-cased path ends in a media extension."""
    names = "|".join(e.lstrip(".") for e in fixed.MEDIA_EXTENSIONS)
    return F.lower(path).rlike(rf"(?s)\.(?:{names})\z")


def is_prohibited_path(path: Column, words: Iterable[str] = fixed.PROHIBITED_SEGMENTS) -> Column:
    """True when a whole ``/``-separated segment equals a prohibited word."""
    return F.arrays_overlap(F.split(F.lower(path), "/", -1), F.array(*[F.lit(w) for w in words]))


# -- public functions ------------------------------------------------------

@cache
def _normalize_steps(drop_params, sort_keys: bool, compat: bool, keep_path_case: bool) -> list[Step]:
    """Steps from inputs ``url`` and ``base`` to ``normalized``."""

    def relative(g: Lookup) -> Column:
        return g("u_netloc") == ""

    def part(name: str):
        return (f"n_{name}", lambda g: F.when(relative(g), g(f"j_{name}")).otherwise(g(f"u_{name}")))

    def target(g: Lookup) -> Column:
        # a relative link is joined by its path alone; otherwise query kept
        if compat:
            return g("u_path")
        return F.concat(g("u_path"), F.when(g("u_params") == "", F.lit("")).otherwise(F.concat(F.lit(";"), g("u_params"))),
                        F.when(g("u_query") == "", F.lit("")).otherwise(F.concat(F.lit("?"), g("u_query"))))

    def keep(g: Lookup) -> Column:
        ok = ~is_media_path(g("n_path")) & ~is_prohibited_path(g("n_path")) & ~_bad_host(g("n_netloc")) & ~_bad_host(g("u_netloc"))
        if not compat:
            ok = ok & g("u_scheme").isin("", "http", "https")
        return ok

    def final(g: Lookup) -> Column:
        path = g("n_path") if keep_path_case else F.lower(g("n_path"))
        text = _compose(g("n_scheme"), F.lower(g("n_netloc")), path, g("n_params"), g("n_cquery"))
        return F.when(g("n_keep"), F.rtrim(text, F.lit("/")))

    return [
        ("url0", lambda g: F.coalesce(g("url"), F.lit(""))),
        ("base0", lambda g: F.coalesce(g("base"), F.lit(""))),
        *_parse_steps("u_", "url0"),
        *_parse_steps("b_", "base0"),
        ("target", target),
        *_parse_steps("r_", "target"),
        *_join_steps("b_", "r_", "j_"),
        *[part(n) for n in ("scheme", "netloc", "path", "params", "query")],
        ("n_keep", keep),
        ("n_cquery", lambda g: F.when(g("n_keep"), canonical_query(g("n_query"), drop_params, sort_keys))),
        ("normalized", final),
    ]


def normalize_url(url: Column, base: Column, *, drop_params: Iterable[str] = ("page",), sort_keys: bool = False,
                  compat: bool = True, keep_path_case: bool = False) -> Column:
    """Canonical absolute form of a link, or null when the link is filtered.

    ``compat=False`` keeps the query of relative links and drops schemes other
    than http and https.
    """
    steps = _normalize_steps(tuple(drop_params), sort_keys, compat, keep_path_case)
    return as_column({"url": url, "base": base}, steps)


def with_normalized_url(df: DataFrame, url: str = "href", base: str = "page_url", out: str = "url", *,
                        drop_params: Iterable[str] = ("page",), sort_keys: bool = False,
                        compat: bool = True, keep_path_case: bool = False, drop_filtered: bool = False) -> DataFrame:
    """:func:`normalize_url` as a new column; ``drop_filtered`` leaves out links without one."""
    steps = _normalize_steps(tuple(drop_params), sort_keys, compat, keep_path_case)
    return with_steps(df, {"url": F.col(url), "base": F.col(base)}, steps, {out: "normalized"}, out if drop_filtered else None)


_PARTS = ("scheme", "netloc", "path", "params", "query", "fragment")


def url_parts(url: Column) -> Column:
    """Struct of scheme, netloc, path, params, query and fragment."""
    steps = [*_parse_steps("u_", "url"), ("parts", lambda g: F.struct(*[g(f"u_{n}").alias(n) for n in _PARTS]))]
    return as_column({"url": url}, steps)


def with_url_parts(df: DataFrame, url: str, prefix: str = "", parts: Iterable[str] = _PARTS) -> DataFrame:
    """Add the parts of ``url`` as columns ``{prefix}scheme`` .. ``{prefix}fragment``."""
    return with_steps(df, {"url": F.col(url)}, _parse_steps("u_", "url"), {f"{prefix}{n}": f"u_{n}" for n in parts})


@cache
def _absolute_steps() -> list[Step]:
    return [
        ("ref0", lambda g: F.coalesce(g("ref"), F.lit(""))),
        ("base0", lambda g: F.coalesce(g("base"), F.lit(""))),
        *_parse_steps("b_", "base0"),
        *_parse_steps("r_", "ref0"),
        *_join_steps("b_", "r_", "j_"),
        ("absolute", lambda g: F.when(g("ref0") == "", g("base0")).when(g("j_mode") == "foreign", g("ref0")).otherwise(
            _compose(g("j_scheme"), g("j_netloc"), g("j_path"), g("j_params"), g("j_query"), g("j_fragment")))),
    ]


def resolve_url(base: Column, ref: Column) -> Column:
    """A reference made absolute against a base URL."""
    return as_column({"base": base, "ref": ref}, _absolute_steps())


def with_resolved_url(df: DataFrame, ref: str, base: str, out: str) -> DataFrame:
    """:func:`resolve_url` as a new column."""
    return with_steps(df, {"base": F.col(base), "ref": F.col(ref)}, _absolute_steps(), {out: "absolute"})


def resolve_link(url: Column, base: Column) -> Column:
    """A link made absolute by its path alone; absolute links stay as they are."""
    steps = [
        ("url0", lambda g: F.coalesce(g("url"), F.lit(""))),
        *_parse_steps("u_", "url0"),
        ("ref", lambda g: g("u_path")),
        *_absolute_steps(),
        ("link", lambda g: F.when(g("u_netloc") == "", g("absolute")).otherwise(g("url0"))),
    ]
    return as_column({"url": url, "base": base}, steps)


@cache
def _image_steps() -> list[Step]:
    """Root-relative sources join the host, other relative ones the page."""
    def base(g: Lookup) -> Column:
        root = F.concat(g("p_scheme"), F.lit("://"), g("p_netloc"))
        return F.when(F.startswith(g("src"), F.lit("/")), root).otherwise(g("page_url"))

    def final(g: Lookup) -> Column:
        web = F.startswith(g("src"), F.lit("http://")) | F.startswith(g("src"), F.lit("https://"))
        return F.when(web, g("src")).otherwise(g("absolute"))

    return [
        *_parse_steps("p_", "page_url"),
        ("ref", lambda g: g("src")),
        ("base", base),
        *_absolute_steps(),
        ("image_url", final),
    ]


def resolve_image(src: Column, page_url: Column) -> Column:
    """Absolute address of an image source found on ``page_url``."""
    return as_column({"src": src, "page_url": page_url}, _image_steps())


def with_image_url(df: DataFrame, src: str = "src", page_url: str = "page_url", out: str = "image_url") -> DataFrame:
    """:func:`resolve_image` as a new column."""
    return with_steps(df, {"src": F.col(src), "page_url": F.col(page_url)}, _image_steps(), {out: "image_url"})


def path_section(path: Column) -> Column:
    """First path segment in lower case, or ``root``."""
    first = F.lower(F.substring_index(F.ltrim(path, F.lit("/")), "/", 1))
    return F.when(first == "", F.lit("root")).otherwise(first)


def host(netloc: Column) -> Column:
    """Host of a netloc, without user and port."""
    return F.substring_index(F.substring_index(netloc, "@", -1), ":", 1)
