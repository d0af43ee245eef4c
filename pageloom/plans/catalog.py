"""The query catalogue: one entry per operator, with its SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import fixed, hashes, labels
from pageloom.functions import urls as u
from pageloom.operators import dedup as dd
from pageloom.operators import domains as dm
from pageloom.operators import embed as em
from pageloom.operators import frontier as fr
from pageloom.operators import links as ln
from pageloom.operators import logs as lg
from pageloom.operators import manifest as mf
from pageloom.operators import report as rp
from pageloom.operators import sections as sc
from pageloom.plans import composites as cp
from pageloom.plans import oracles as o
from pageloom.plans import views as v
from pageloom.sources import images as im
from pageloom.sources import scratch, sinks
from pageloom.sources import tables as tb
from pageloom.streaming import streams as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = o.with_views(sql.strip())
        return fn
    return add


# -- sources ---------------------------------------------------------------

@query("scan_seeds", r"SELECT ord, regexp_replace(domain, '^\s+|\s+$', '', 'g') AS domain FROM messy_seeds WHERE domain IS NOT NULL")
def _(spark, sf):
    return tb.scan_seeds(v.messy_seeds(spark, sf))


@query("select_seeds", r"""
    SELECT r.pos, s.domain FROM (VALUES (1, 3), (2, 1), (3, 3), (4, 40)) AS r(pos, number)
    JOIN (SELECT regexp_replace(domain, '^\s+|\s+$', '', 'g') AS domain, row_number() OVER (ORDER BY ord) AS number
          FROM messy_seeds WHERE domain IS NOT NULL) s USING (number)""")
def _(spark, sf):
    return tb.select_seeds(v.messy_seeds(spark, sf), "3, 1,3,40")


@query("fetch_pages", "SELECT f.site, f.url, p.page_id FROM (SELECT DISTINCT site, url FROM found) f JOIN site_pages p ON p.url = f.url")
def _(spark, sf):
    table = fr.page_key(v.site_pages(spark, sf), "url", "key").select("key", "page_id")
    level = fr.first_seen(v.found(spark, sf)).withColumn("key", F.col("url"))
    return fr.fetch_pages(level, table).select("site", "url", "page_id")


@query("fetch_failures", "SELECT DISTINCT f.site, f.url FROM found f WHERE NOT EXISTS (SELECT 1 FROM site_pages p WHERE p.url = f.url)")
def _(spark, sf):
    table = fr.page_key(v.site_pages(spark, sf), "url", "key")
    level = fr.first_seen(v.found(spark, sf)).withColumn("key", F.col("url"))
    return fr.fetch_failures(level, table).select("site", "url")


_SHEETS = """SELECT CASE depth WHEN 0 THEN 'depth level 0' WHEN 1 THEN 'Summary' ELSE concat('Depth Level ', depth) END AS sheet,
    page_url, image_url, trail, pos, image_depth FROM report"""


def _sheets(spark, sf):
    rows = rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))
    depth = F.col("depth")
    return rows.withColumn("sheet", F.when(depth == 0, "depth level 0").when(depth == 1, "Summary").otherwise(labels.depth_sheet(depth)))


@query("scan_report", f"SELECT sheet, page_url, image_url FROM ({_SHEETS}) WHERE sheet ILIKE 'depth level%'")
def _(spark, sf):
    return mf.scan_report(_sheets(spark, sf)).select("sheet", "page_url", "image_url")


@query("scan_images", "SELECT DISTINCT image_url AS path FROM walked_images WHERE regexp_matches(lower(image_url), '[.](png|jpg|jpeg)$')")
def _(spark, sf):
    return im.keep_images(v.walked_images(spark, sf).select(F.col("image_url").alias("path")).distinct())


@query("scan_images_ext", "SELECT DISTINCT image_url AS path FROM walked_images WHERE regexp_matches(lower(image_url), '[^./][.](png|jpg|jpeg|webp)$')")
def _(spark, sf):
    return im.keep_images_ext(v.walked_images(spark, sf).select(F.col("image_url").alias("path")).distinct())


@query("image_metadata", "SELECT ord, size_bytes / 1024.0::DOUBLE AS size_kb, concat(width, 'x', height) AS dims FROM img_items")
def _(spark, sf):
    return im.image_metadata(v.img_items(spark, sf)).select("ord", "size_kb", "dims")


@query("skip_broken", "SELECT ord, width FROM img_items WHERE ord % 10 <> 0")
def _(spark, sf):
    width = F.when(F.col("ord") % 10 == 0, -1).otherwise(F.col("width"))
    return im.skip_broken(v.img_items(spark, sf).withColumn("width", width)).select("ord", "width")


# -- filters and projections -----------------------------------------------

_PATHS = r"SELECT page_id, pos, form, href, regexp_extract(href, '^(?:[A-Za-z]+:)?(?://[^/?#]*)?([^?#]*)', 1) AS path FROM link_forms"


def _paths(spark, sf):
    return u.with_url_parts(v.link_forms(spark, sf), "href", "", ["path", "params", "netloc"])


@query("filter_media_paths", f"SELECT page_id, pos, form FROM ({_PATHS}) WHERE NOT regexp_matches(lower(path), '[.]({'|'.join(e[1:] for e in fixed.MEDIA_EXTENSIONS)})$')")
def _(spark, sf):
    return _paths(spark, sf).filter(~u.is_media_path(F.col("path"))).select("page_id", "pos", "form")


@query("filter_prohibited", f"SELECT page_id, pos, form FROM ({_PATHS}) WHERE NOT list_has_any(string_split(lower(path), '/'), [{', '.join(repr(w) for w in fixed.PROHIBITED_SEGMENTS)}])")
def _(spark, sf):
    return _paths(spark, sf).filter(~u.is_prohibited_path(F.col("path"))).select("page_id", "pos", "form")


@query("filter_internal", f"""SELECT domain, ord, href FROM section_links
    WHERE contains(lower(regexp_extract(href, '^[A-Za-z]+://([^/?#]*)', 1)), {o.domain_of(o.host_of('domain'))})""")
def _(spark, sf):
    return dm.filter_internal(dm.with_main_domain(v.section_links(spark, sf), "domain", v.SUFFIXES)).select("domain", "ord", "href")


@query("exclude_external", "SELECT page_id, pos, url FROM edges")
def _(spark, sf):
    rows = dm.with_main_domain(ln.normalized_links(v.page_links(spark, sf)), "page_url", v.SUFFIXES)
    return dm.exclude_external(rows, "url", "main_domain", v.SUFFIXES).select("page_id", "pos", "url")


@query("exclude_social", f"SELECT page_id, pos, url FROM links_normal WHERE url IS NOT NULL AND url <> '' AND {o.domain_of(o.host_of('url'))} NOT IN (SELECT domain FROM social)")
def _(spark, sf):
    return dm.exclude_social(ln.normalized_links(v.page_links(spark, sf)), v.SOCIAL, "url", v.SUFFIXES).select("page_id", "pos", "url")


@query("filter_image_src", "SELECT page_id, pos, src FROM page_media WHERE src <> ''")
def _(spark, sf):
    return ln.filter_image_src(v.page_media(spark, sf))


@query("filter_manifest", "SELECT page_url, image_url FROM report WHERE image_url IS NOT NULL AND image_url <> ''")
def _(spark, sf):
    return mf.filter_manifest(rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))).select("page_url", "image_url")


@query("drop_empty_inference", "SELECT DISTINCT image_path FROM faces WHERE len(faces) > 0")
def _(spark, sf):
    return em.explode_faces(v.faces(spark, sf)).select("image_path").distinct()


@query("drop_null_urls", "SELECT page_id, pos, form, url FROM forms_normal WHERE url IS NOT NULL AND url <> ''")
def _(spark, sf):
    return ln.normalized_links(v.link_forms(spark, sf)).select("page_id", "pos", "form", "url")


@query("project_images", "SELECT image_url, page_url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM walked_images")
def _(spark, sf):
    return fr.project_images(v.walked_images(spark, sf)).select("image_url", "page_url", labels.format_ts(F.col("ts")).alias("ts"))


@query("project_crawled", "SELECT site, depth, url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM walked")
def _(spark, sf):
    return fr.project_crawled(v.walked(spark, sf)).withColumn("ts", labels.format_ts(F.col("ts")))


# -- joins -----------------------------------------------------------------

@query("join_pages_images", "SELECT site, depth, page_url, image_url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM report")
def _(spark, sf):
    rows = rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))
    return rows.select("site", "depth", "page_url", "image_url", labels.format_ts(F.col("ts")).alias("ts"))


@query("anti_visited", "SELECT DISTINCT site, url FROM found f WHERE NOT EXISTS (SELECT 1 FROM walked w WHERE w.site = f.site AND w.url = f.url)")
def _(spark, sf):
    return fr.anti_visited(fr.first_seen(v.found(spark, sf)), v.walked(spark, sf)).select("site", "url")


@query("join_level_limits", """SELECT w.site, w.depth, w.url, l.max_urls FROM walked w
    LEFT JOIN (VALUES (0, NULL), (1, 2), (2, NULL), (3, 4)) AS l(depth, max_urls) ON l.depth = w.depth""")
def _(spark, sf):
    limits = fr.limits_table(spark, v.LIMITS, 3)
    return fr.with_limit(v.walked(spark, sf), limits).select("site", "depth", "url", "max_urls")


@query("join_url_result", "SELECT f.site, f.url, p.page_id IS NOT NULL AS success FROM (SELECT DISTINCT site, url FROM found) f LEFT JOIN site_pages p ON p.url = f.url")
def _(spark, sf):
    return fr.with_result(fr.first_seen(v.found(spark, sf)), v.site_pages(spark, sf)).select("site", "url", "success")


@query("similar_pairs", f"""SELECT i.ord, l.ord AS leader_ord FROM items i JOIN (SELECT * FROM grouped WHERE ord = leader_ord) l
    ON {o.char_distance('i.phash', 'l.phash')} <= {o.T} AND {o.char_distance('i.ahash', 'l.ahash')} <= {o.T}""")
def _(spark, sf):
    groups = scratch.materialise(dd.leader_groups(v.hashed_items(spark, sf)), "groups")
    return dd.similar_pairs(groups, groups.filter("ord = leader_ord"))


@query("suffix_match", f"SELECT DISTINCT {o.host_of('page_url')} AS host, {o.domain_of(o.host_of('page_url'))} AS main_domain FROM raw_links")
def _(spark, sf):
    hosts = u.with_url_parts(v.pages(spark, sf), "url", "", ["netloc"]).select(u.host(F.col("netloc")).alias("host"))
    suffixes = spark.createDataFrame([(s,) for s in v.SUFFIXES], "suffix string")
    return dm.suffix_match(hosts, suffixes).select("host", "main_domain")


@query("original_case", "SELECT domain, href_lower, href FROM section_first")
def _(spark, sf):
    own = dm.filter_internal(dm.with_main_domain(v.section_links(spark, sf), "domain", v.SUFFIXES))
    return sc.distinct_links(own).select("domain", "href_lower", "href")


# -- aggregations ----------------------------------------------------------

@query("urls_per_depth", "SELECT site, depth, count(*) AS n_urls FROM walked GROUP BY ALL")
def _(spark, sf):
    return rp.urls_per_depth(v.walked(spark, sf))


@query("images_per_depth", "SELECT site, depth, count(image_url) AS n_images FROM report GROUP BY ALL")
def _(spark, sf):
    return rp.images_per_depth(v.walked(spark, sf), v.walked_images(spark, sf))


_SUMMARY = """
    SELECT site, depth, CASE WHEN grouping(depth) = 0 THEN concat('Depth ', depth) ELSE 'Total' END AS label,
      sum(n)::BIGINT AS n_urls, sum(m)::BIGINT AS n_images
    FROM (SELECT c.site, c.depth, count(*) AS n, 0 AS m FROM {crawled} c GROUP BY ALL
          UNION ALL SELECT site, depth, 0, count(image_url) FROM {report} GROUP BY ALL)
    GROUP BY GROUPING SETS ((site, depth), (site))"""


@query("depth_summary", _SUMMARY.format(crawled="walked", report="report"))
def _(spark, sf):
    return rp.depth_summary(v.walked(spark, sf), v.walked_images(spark, sf))


@query("total_links", """SELECT site, n_crawled, n_discovered, n_crawled + n_discovered AS total_links
    FROM (SELECT site, count(*) AS n_crawled FROM walked GROUP BY 1) JOIN (SELECT site, count(DISTINCT url) AS n_discovered FROM found GROUP BY 1) USING (site)""")
def _(spark, sf):
    return rp.total_links(v.walked(spark, sf), fr.first_seen(v.found(spark, sf)))


@query("total_images", "SELECT site, count(*) AS total_images FROM walked_images GROUP BY 1")
def _(spark, sf):
    return rp.total_images(v.walked_images(spark, sf))


@query("total_images_joined", "SELECT site, count(image_url) AS total_images_joined FROM report GROUP BY 1")
def _(spark, sf):
    return rp.total_images_joined(v.walked(spark, sf), v.walked_images(spark, sf))


@query("crawled_pages", "SELECT site, count(*) AS crawled_pages FROM walked GROUP BY 1")
def _(spark, sf):
    return rp.crawled_pages(v.walked(spark, sf))


@query("level_stats", """
    SELECT site, depth, n_found, max_urls, least(n_found, max_urls) AS n_taken, (least(n_found, max_urls) + 9) // 10 AS n_batches
    FROM (SELECT site, depth, count(*) AS n_found FROM walked GROUP BY ALL)
    LEFT JOIN (VALUES (0, NULL), (1, 2), (2, NULL), (3, 4)) AS l(depth, max_urls) USING (depth)""")
def _(spark, sf):
    return fr.level_stats(v.walked(spark, sf), fr.limits_table(spark, v.LIMITS, 3), 10)


@query("distinct_links", "SELECT domain, href FROM section_first")
def _(spark, sf):
    own = dm.filter_internal(dm.with_main_domain(v.section_links(spark, sf), "domain", v.SUFFIXES))
    return sc.distinct_links(own).select("domain", "href")


def _sectioned(spark, sf):
    own = dm.filter_internal(dm.with_main_domain(v.section_links(spark, sf), "domain", v.SUFFIXES))
    return sc.group_by_section(sc.distinct_links(own))


@query("group_by_section", "SELECT domain, section, href_lower FROM section_named")
def _(spark, sf):
    return _sectioned(spark, sf).select("domain", "section", "href_lower")


@query("fold_singleton_sections", "SELECT domain, section, count(*) AS n_urls FROM section_folded GROUP BY ALL")
def _(spark, sf):
    return sc.section_sizes(sc.fold_singleton_sections(_sectioned(spark, sf)))


@query("sections_sorted", "SELECT domain, section, row_number() OVER (PARTITION BY domain, section ORDER BY href) AS pos, href AS url FROM section_folded")
def _(spark, sf):
    return sc.sections_sorted(sc.fold_singleton_sections(_sectioned(spark, sf)))


@query("manifest_count", "SELECT site, depth, count(*) AS n_attempted FROM manifest GROUP BY ROLLUP (site, depth)")
def _(spark, sf):
    return mf.manifest_count(mf.download_manifest(rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))))


@query("download_count", """SELECT regexp_extract(url, '^[a-z]+://[^/]+') AS site, CAST(string_split(req_id, '-')[1]::BIGINT % 5 AS INT) AS depth,
      count(*) FILTER (WHERE outcome = 'saved') AS n_saved FROM outcomes GROUP BY 1, 2""")
def _(spark, sf):
    return mf.download_count(cp.attempts_by_depth(spark, sf))


@query("exact_hash_groups", "SELECT phash, ahash, count(*) AS n_items, min(ord) AS first_ord FROM items GROUP BY ALL")
def _(spark, sf):
    return dd.exact_hash_groups(v.hashed_items(spark, sf))


def _acted(spark, sf):
    return dd.with_action(scratch.materialise(dd.leader_groups(v.hashed_items(spark, sf)), "groups"))


@query("best_per_group", "SELECT group_no, ord AS best_ord FROM acted WHERE action = 'Retained'")
def _(spark, sf):
    return dd.best_per_group(dd.leader_groups(v.hashed_items(spark, sf)))


@query("dedup_summary", """
    SELECT group_no, count(*) AS n_items, max(ord) FILTER (WHERE action = 'Retained') AS kept_ord,
      count(*) FILTER (WHERE action <> 'Retained') AS n_removed,
      sum(CASE WHEN action = 'Retained' THEN size_bytes ELSE 0 END)::BIGINT AS bytes_kept,
      sum(CASE WHEN action = 'Retained' THEN 0 ELSE size_bytes END)::BIGINT AS bytes_removed
    FROM acted GROUP BY 1""")
def _(spark, sf):
    return dd.dedup_summary(_acted(spark, sf))


@query("face_counts", """SELECT image_path, sum(n)::BIGINT AS n_faces, count(*) AS n_images
    FROM (SELECT image_path, len(faces) AS n FROM faces WHERE len(faces) > 0) GROUP BY ROLLUP (image_path)""")
def _(spark, sf):
    return em.face_counts(em.explode_faces(v.faces(spark, sf)))


_ROLLUP = """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'IN_PROGRESS') AS active,
    count(*) FILTER (WHERE status = 'COMPLETED') AS completed, count(*) FILTER (WHERE status = 'FAILED') AS failed,
    round(sum(memory_mb), 4) AS memory_mb FROM task_log"""


@query("status_rollup", _ROLLUP)
def _(spark, sf):
    return lg.status_rollup(v.task_log(spark, sf)).withColumn("memory_mb", F.round("memory_mb", 4))


# -- numbering, order, limits ----------------------------------------------

@query("manifest_rownum", """SELECT site, depth, page_url, image_url, 1 + row_number() OVER (PARTITION BY site, depth
    ORDER BY trail, image_depth NULLS FIRST, image_trail NULLS FIRST, pos NULLS FIRST) AS row_num FROM report""")
def _(spark, sf):
    rows = rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))
    return mf.manifest_rownum(rows, ["site", "depth"], rp.REPORT_ORDER).select("site", "depth", "page_url", "image_url", "row_num")


@query("batch_number", "SELECT site, depth, url, (row_number() OVER (PARTITION BY site, depth ORDER BY trail) - 1) // 10 + 1 AS batch FROM walked")
def _(spark, sf):
    return fr.batch_number(fr.with_ord(v.walked(spark, sf)), 10).select("site", "depth", "url", "batch")


@query("first_seen", "SELECT site, url, min(trail)[1] AS page_id, min(trail)[2] AS pos FROM found GROUP BY ALL")
def _(spark, sf):
    return fr.first_seen(v.found(spark, sf)).select("site", "url", F.col("trail")[0].alias("page_id"), F.col("trail")[1].alias("pos"))


@query("rank_in_group", "SELECT group_no, rank, ord, action FROM ranked")
def _(spark, sf):
    return dd.rank_in_group(_acted(spark, sf)).select("group_no", "rank", "ord", "action")


@query("group_number", "SELECT leader_ord, group_no FROM grouped WHERE ord = leader_ord")
def _(spark, sf):
    groups = dd.leader_groups(v.hashed_items(spark, sf))
    return groups.filter("ord = leader_ord").select("leader_ord", "group_no")


@query("sort_depths", "SELECT site, depth, count(*) AS n_urls FROM walked GROUP BY ALL ORDER BY depth, site")
def _(spark, sf):
    return rp.urls_per_depth(v.walked(spark, sf)).orderBy("depth", "site")


@query("limit_per_depth", "SELECT site, depth, url, trail[1] AS k FROM walked QUALIFY row_number() OVER (PARTITION BY site, depth ORDER BY trail) <= 5")
def _(spark, sf):
    walked = v.walked(spark, sf)
    levels = [fr.limit_per_depth(walked.filter(F.col("depth") == d), 5) for d in range(v.WALK_DEPTH + 1)]
    return reduce(DataFrame.unionAll, levels).select("site", "depth", "url", F.get("trail", F.lit(0)).alias("k"))


@query("monitor_topn", """SELECT task_id, status, end_time FROM task_log
    ORDER BY status <> 'IN_PROGRESS', status <> 'QUEUED', end_time NULLS LAST, start_time, task_id LIMIT 15""")
def _(spark, sf):
    return lg.monitor_topn(v.task_log(spark, sf)).select("task_id", "status", "end_time")


@query("depth_cutoff", "SELECT site, url, depth FROM walk_crawled WHERE depth <= 1")
def _(spark, sf):
    return cp.walk(spark, sf, depth=1).crawled.select("site", "url", "depth")


# -- set operations --------------------------------------------------------

@query("union_levels", "SELECT site, url, 'crawled' AS kind FROM walked UNION ALL SELECT DISTINCT site, url, 'discovered' FROM found")
def _(spark, sf):
    return fr.union_levels(v.walked(spark, sf), fr.first_seen(v.found(spark, sf)))


@query("visited_distinct", "SELECT DISTINCT site, url FROM found")
def _(spark, sf):
    return fr.visited(v.found(spark, sf))


@query("root_merge", "SELECT domain, href AS url FROM section_folded WHERE section = 'root'")
def _(spark, sf):
    folded = sc.fold_singleton_sections(_sectioned(spark, sf))
    return folded.filter("section = 'root'").select("domain", F.col("href").alias("url"))


@query("extend_results", "SELECT image_path, len(faces) AS n FROM faces UNION ALL SELECT image_path, len(faces) FROM faces WHERE len(faces) = 0")
def _(spark, sf):
    rows = v.faces(spark, sf).select("image_path", F.size("faces").cast("long").alias("n"))
    return em.extend_results(rows, rows.filter("n = 0"))


#: All numbers of a vector in millionths, as both sides write them.
def _whole(vector):
    return F.concat_ws(",", F.transform(vector, lambda x: F.round(x.cast("double") * 1_000_000).cast("long").cast("string")))


def _whole_sql(vector: str) -> str:
    return f"array_to_string(list_transform({vector}, lambda x: CAST(CAST(round(x * 1000000) AS BIGINT) AS VARCHAR)), ',')"


# -- scalar functions ------------------------------------------------------

@query("url_parts", f"SELECT page_id, pos, form, lower(u.scheme) AS scheme, u.netloc AS netloc, {o._path('u.scheme', 'u.path')} AS path, {o._params('u.scheme', 'u.path')} AS params, u.query AS query, u.fragment AS fragment FROM forms_normal_parts")
def _(spark, sf):
    return u.with_url_parts(v.link_forms(spark, sf), "href").select("page_id", "pos", "form", *u._PARTS)


@query("main_domain", f"SELECT page_id, {o.domain_of(o.host_of('url'))} AS main_domain FROM pages")
def _(spark, sf):
    return dm.with_main_domain(v.pages(spark, sf).select("page_id", "url"), "url", v.SUFFIXES).select("page_id", "main_domain")


@query("resolve_link", "SELECT page_id, pos, form, CASE WHEN form IN (4, 8) THEN href WHEN form IN (1, 2) THEN page_url ELSE joined END AS link FROM forms_normal")
def _(spark, sf):
    rows = v.link_forms(spark, sf)
    return rows.select("page_id", "pos", "form", u.resolve_link(F.col("href"), F.col("page_url")).alias("link"))


@query("resolve_image", f"SELECT page_id, pos, {o.image_url('src', 'url')} AS image_url FROM page_media JOIN site_pages USING (page_id) WHERE src <> ''")
def _(spark, sf):
    media = ln.filter_image_src(v.page_media(spark, sf)).join(v.site_pages(spark, sf).select("page_id", F.col("url").alias("page_url")), "page_id")
    return ln.absolute_images(media).select("page_id", "pos", "image_url")


@query("canonical_query", f"SELECT page_id, pos, form, CASE WHEN u.query = '' THEN '' ELSE {o._query('u.query')} END AS query FROM forms_normal_parts")
def _(spark, sf):
    rows = u.with_url_parts(v.link_forms(spark, sf), "href", "", ["query"])
    return rows.select("page_id", "pos", "form", u.canonical_query(F.col("query")).alias("query"))


@query("normalize_url", "SELECT page_id, pos, form, url FROM forms_normal")
def _(spark, sf):
    return u.with_normalized_url(v.link_forms(spark, sf)).select("page_id", "pos", "form", "url")


@query("path_section", r"""SELECT page_id, pos, form, CASE WHEN s = '' THEN 'root' ELSE s END AS section
    FROM (SELECT *, lower(string_split(trim(regexp_replace(path, ';[^/]*$', ''), '/'), '/')[1]) AS s FROM (""" + _PATHS + r") )")
def _(spark, sf):
    rows = _paths(spark, sf)
    return rows.select("page_id", "pos", "form", u.path_section(F.col("path")).alias("section"))


@query("depth_label", "SELECT page_id, depth, concat('Depth Level ', depth) AS sheet, concat('Depth ', depth) AS label FROM walked")
def _(spark, sf):
    d = F.col("depth")
    return v.walked(spark, sf).select("page_id", "depth", labels.depth_sheet(d).alias("sheet"), labels.depth_label(d).alias("label"))


@query("extract_depth", f"SELECT sheet, CASE WHEN sheet = 'Summary' THEN 0 ELSE string_split(sheet, ' ')[3]::INT END AS depth FROM ({_SHEETS})")
def _(spark, sf):
    return _sheets(spark, sf).select("sheet", labels.extract_depth(F.col("sheet")).alias("depth"))


@query("manifest_filename", "SELECT page_id, concat(page_id + 2, '_d', depth) AS filename, concat('Downloaded_Images/Depth Level ', depth) AS folder FROM walked")
def _(spark, sf):
    d = F.col("depth")
    return v.walked(spark, sf).select("page_id", labels.manifest_name(F.col("page_id") + 2, d).alias("filename"),
                                      labels.manifest_folder(labels.depth_sheet(d)).alias("folder"))


@query("format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def _(spark, sf):
    return v.events(spark, sf).select("event_id", labels.format_ts(F.col("ts")).alias("ts"))


@query("dims_label", "SELECT ord, concat(width, 'x', height) AS dims, printf('%.2f', size_bytes / 1024.0::DOUBLE) AS size FROM img_items")
def _(spark, sf):
    return v.img_items(spark, sf).select(
        "ord", labels.dims_label(F.col("width"), F.col("height")).alias("dims"),
        labels.size_label(labels.size_kb(F.col("size_bytes"))).alias("size"))


@query("basename", r"SELECT page_id, pos, parse_filename(src, false, '/') AS name, lower(regexp_extract(src, '([.][^./]+)$', 1)) AS ext FROM page_media WHERE src <> ''")
def _(spark, sf):
    src = F.col("src")
    return ln.filter_image_src(v.page_media(spark, sf)).select("page_id", "pos", labels.basename(src).alias("name"), labels.extension(src).alias("ext"))


@query("hex_distance", f"""SELECT a.ord, {o.char_distance('a.phash', 'b.phash')}::INT AS p_dist, {o.char_distance('a.ahash', 'b.ahash')}::INT AS a_dist
    FROM items a JOIN items b ON b.ord = a.ord + 1""")
def _(spark, sf):
    a = v.hashed_items(spark, sf).select("ord", "phash", "ahash")
    b = a.select((F.col("ord") - 1).alias("ord"), F.col("phash").alias("phash2"), F.col("ahash").alias("ahash2"))
    return a.join(b, "ord").select("ord", hashes.hex_distance(F.col("phash"), F.col("phash2")).alias("p_dist"),
                                   hashes.hex_distance(F.col("ahash"), F.col("ahash2")).alias("a_dist"))


@query("average_hash", "SELECT ord, ahash FROM ahashes")
def _(spark, sf):
    return v.img_items(spark, sf).select("ord", hashes.average_hash(F.col("px")).alias("ahash"))


@query("perceptual_hash", "SELECT ord, phash FROM phashes")
def _(spark, sf):
    return v.img_items(spark, sf).select("ord", hashes.perceptual_hash(F.col("px"), 8).alias("phash"))


@query("embedding_json", f"""SELECT image_path, i AS face_index, {_whole_sql('f')} AS vector
    FROM (SELECT image_path, generate_subscripts(faces, 1) - 1 AS i, unnest(faces)::DOUBLE[] AS f FROM faces)""")
def _(spark, sf):
    rows = em.embedding_array(em.embedding_json(em.explode_faces(v.faces(spark, sf))))
    return rows.select("image_path", "face_index", _whole(F.col("embedding")).alias("vector"))


# -- nested data -----------------------------------------------------------

@query("extract_links", "SELECT page_id, page_url, pos, href FROM raw_links")
def _(spark, sf):
    return v.raw_links(spark, sf)


_HTML = """concat('<html><body><!-- <img src="no.png"> -->', {html}, '<IMG alt="1>2" SRC=''/static/', page_id, '.jpg''>',
    '<img data-src="x"><img src="thumbs/', page_id, '.webp?a=1&amp;b=2"/></body></html>')"""


@query("extract_images", """
    SELECT page_id, 0 AS pos, concat('/static/', page_id, '.jpg') AS src FROM pages
    UNION ALL SELECT page_id, 2, concat('thumbs/', page_id, '.webp?a=1&b=2') FROM pages""")
def _(spark, sf):
    html = F.expr(_HTML.format(html="html").replace("''", "\\'"))
    return ln.extract_images(v.pages(spark, sf).withColumn("html", html)).select("page_id", "pos", "src")


@query("extract_tags", """
    SELECT page_id, 'a' AS kind, pos, href AS value FROM raw_links
    UNION ALL SELECT page_id, 'img', 0, concat('/static/', page_id, '.jpg') FROM pages
    UNION ALL SELECT page_id, 'img', 1, '' FROM pages
    UNION ALL SELECT page_id, 'img', 2, concat('thumbs/', page_id, '.webp?a=1&b=2') FROM pages""")
def _(spark, sf):
    html = F.expr(_HTML.format(html="html").replace("''", "\\'"))
    return ln.extract_tags(v.pages(spark, sf).withColumn("html", html)).select("page_id", "kind", "pos", "value")


_FACES = f"""SELECT image_path, i AS face_index, {_whole_sql('f')} AS vector
    FROM (SELECT image_path, generate_subscripts(faces, 1) - 1 AS i, unnest(faces)::DOUBLE[] AS f FROM faces)"""


@query("face_explode", _FACES)
def _(spark, sf):
    rows = em.explode_faces(v.faces(spark, sf))
    return rows.select("image_path", "face_index", _whole(F.col("embedding")).alias("vector"))


@query("sections_json", """
    SELECT domain, 0 AS part, concat('{', to_json(domain), ':{', string_agg(concat(to_json(section), ':', urls), ',' ORDER BY section), '}}') AS json
    FROM (SELECT domain, section, to_json(list(href ORDER BY href)) AS urls FROM section_folded GROUP BY ALL) GROUP BY 1""")
def _(spark, sf):
    nested = sc.sections_document(sc.sections(v.section_links(spark, sf), v.SUFFIXES))
    return nested.select("domain", F.lit(0).alias("part"), "json")


@query("sections_document", """
    SELECT domain, concat('{', to_json(domain), ':{', string_agg(concat(to_json(section), ':', urls), ',' ORDER BY section), '}}') AS json
    FROM (SELECT domain, section, to_json(list(href ORDER BY href)) AS urls FROM section_folded GROUP BY ALL) GROUP BY 1""")
def _(spark, sf):
    return sc.sections_document(sc.sections(v.section_links(spark, sf), v.SUFFIXES))


@query("report_rows", "SELECT site, concat('Depth Level ', depth) AS sheet, page_url, coalesce(image_url, '') AS image_url FROM report")
def _(spark, sf):
    rows = rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))
    return sinks.report_sheet(rows).select("site", "sheet", "page_url", "image_url")


# -- composites ------------------------------------------------------------

@query("links_per_domain", f"SELECT {o.domain_of(o.host_of('url'))} AS main_domain, count(DISTINCT url) AS n_urls FROM raw_normal WHERE url IS NOT NULL AND url <> '' GROUP BY 1")
def links_per_domain(spark, sf):
    return cp.links_per_domain(v.pages(spark, sf), v.SUFFIXES)


_NUMBERED = "SELECT site, url, depth, row_number() OVER (PARTITION BY site, depth ORDER BY trail) AS ord FROM {name}"


@query("crawl_frontier", _NUMBERED.format(name="walk_crawled"))
def _(spark, sf):
    return fr.with_ord(cp.walk(spark, sf).crawled).select("site", "url", "depth", "ord")


@query("crawl_limited", _NUMBERED.format(name="cut_crawled"))
def _(spark, sf):
    return fr.with_ord(cp.cut_walk(spark, sf).crawled).select("site", "url", "depth", "ord")


@query("crawl_discovered", _NUMBERED.format(name="cut_discovered"))
def _(spark, sf):
    return fr.with_ord(cp.cut_walk(spark, sf).discovered).select("site", "url", "depth", "ord")


@query("harvest_images", "SELECT site, depth, page_url, image_url, pos FROM walk_images")
def _(spark, sf):
    return cp.walk_images(spark, sf, cp.walk(spark, sf)).select("site", "depth", "page_url", "image_url", "pos")


@query("crawl_all_sites", """
    SELECT site, n_crawled, n_discovered, n_crawled + n_discovered AS total_links, total_images, total_images_joined
    FROM (SELECT site, count(*) AS n_crawled FROM walk_crawled GROUP BY 1)
    JOIN (SELECT site, count(*) AS n_discovered FROM walk_discovered GROUP BY 1) USING (site)
    JOIN (SELECT site, count(*) AS total_images FROM walk_images GROUP BY 1) USING (site)
    JOIN (SELECT site, count(image_url) AS total_images_joined FROM walk_report GROUP BY 1) USING (site)""")
def _(spark, sf):
    crawl = cp.walk(spark, sf)
    return rp.site_summary(crawl.crawled, crawl.discovered, cp.walk_images(spark, sf, crawl))


@query("leader_groups", "SELECT ord, leader_ord, group_no FROM grouped")
def _(spark, sf):
    return dd.leader_groups(v.hashed_items(spark, sf)).select("ord", "leader_ord", "group_no")


@query("dedup_images", "SELECT group_no, rank, ord, action, size_bytes / 1024.0::DOUBLE AS size_kb, concat(width, 'x', height) AS dims FROM ranked")
def _(spark, sf):
    return dd.dedup(v.hashed_items(spark, sf)).select("group_no", "rank", "ord", "action", "size_kb", "dims")


@query("download_manifest", "SELECT site, depth, row_num, url, filename, folder FROM manifest")
def _(spark, sf):
    return mf.download_manifest(rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf)))


@query("section_report", "SELECT domain, section, href AS url FROM section_folded")
def _(spark, sf):
    return sc.sections(v.section_links(spark, sf), v.SUFFIXES)


@query("embed_images", f"""
    SELECT concat('img/', vec_id, CASE WHEN label % 2 = 0 THEN '.JPG' ELSE '.webp' END) AS image_path, h AS face_index,
      {_whole_sql('(embedding[1 + 32 * h:32 + 32 * h])::DOUBLE[]')} AS vector
    FROM embeddings CROSS JOIN (VALUES (0), (1)) AS t(h) WHERE embedding[1] > 0""")
def _(spark, sf):
    rows = em.explode_faces(em.embed_images(im.keep_images_ext(v.vector_images(spark, sf), "image_path"), cp.halves, 32))
    return rows.select("image_path", "face_index", _whole(F.col("embedding")).alias("vector"))


@query("full_chain", """
    SELECT 'crawled' AS step, count(*) AS n FROM walk_crawled
    UNION ALL SELECT 'images', count(*) FROM walk_images
    UNION ALL SELECT 'manifest', count(image_url) FROM walk_report
    UNION ALL SELECT 'kept', count(*) FROM acted WHERE action = 'Retained'
    UNION ALL SELECT 'vectors', 2 * count(*) FROM acted JOIN img_items USING (ord) WHERE action = 'Retained' AND px[1] > 0""")
def _(spark, sf):
    return cp.full_chain(spark, sf)


# -- logs ------------------------------------------------------------------

@query("fetch_outcome", "SELECT req_id, url, outcome, n_attempts FROM outcomes")
def _(spark, sf):
    return lg.fetch_outcome(v.attempt_log(spark, sf))


_WINDOWS = """
    WITH instant AS (SELECT ts, epoch_us(ts) // 60000000 AS bucket, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ts),
         around AS (SELECT d.ts, e.n, e.ts AS other FROM instant d JOIN instant e ON e.bucket = d.bucket
                    UNION ALL SELECT d.ts, e.n, e.ts FROM instant d JOIN instant e ON e.bucket = d.bucket - 1)
    SELECT ts - INTERVAL '60 seconds' AS window_start, ts AS window_end, CAST(sum(n) AS BIGINT) AS n_requests
    FROM around WHERE other <= ts AND other > ts - INTERVAL '60 seconds' GROUP BY ts HAVING sum(n) > 1"""


@query("rate_audit", _WINDOWS)
def _(spark, sf):
    return lg.rate_audit(v.events(spark, sf), limit=1)


@query("task_monitor", """
    SELECT 'total' AS name, count(*) AS n FROM task_log
    UNION ALL SELECT 'active', count(*) FILTER (WHERE status = 'IN_PROGRESS') FROM task_log
    UNION ALL SELECT 'completed', count(*) FILTER (WHERE status = 'COMPLETED') FROM task_log
    UNION ALL SELECT 'failed', count(*) FILTER (WHERE status = 'FAILED') FROM task_log
    UNION ALL SELECT name, 1 FROM (SELECT task_id AS name FROM task_log
      ORDER BY status <> 'IN_PROGRESS', status <> 'QUEUED', end_time NULLS LAST, start_time, task_id LIMIT 15)""")
def _(spark, sf):
    totals, top = lg.task_monitor(v.task_log(spark, sf))
    states = totals.selectExpr(
        "stack(4, 'total', total, 'active', active, 'completed', completed, 'failed', failed) AS (name, n)")
    return states.unionAll(top.select("task_id", F.lit(1).cast("long")))


@query("throttle_codes", f"""SELECT regexp_extract(url, '^https://[^/]+') AS site, count(*) AS n_responses,
    count(*) FILTER (WHERE status IN ({', '.join(map(str, fixed.THROTTLE_CODES))})) AS n_throttled,
    round(avg(CASE WHEN status IN ({', '.join(map(str, fixed.THROTTLE_CODES))}) THEN 1.0 ELSE 0.0 END), 6) AS throttled_share
    FROM attempt_log WHERE status IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    log = v.attempt_log(spark, sf).withColumn("site", F.regexp_extract("url", "^https://[^/]+", 0))
    return lg.throttle_codes(log).withColumn("throttled_share", F.round("throttled_share", 6))


# -- streams: run over what is there, then read back -----------------------

def _stream(spark, sf, name, schema):
    # as a pattern the name may be one file or a folder of files
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}[.]parquet")


_ADDRESSES = "SELECT DISTINCT page_id % 4 AS site, url FROM raw_normal WHERE url IS NOT NULL AND url <> ''"


@query("stream_discover", _ADDRESSES)
def _(spark, sf):
    arriving = _stream(spark, sf, "pages", tb.PAGES).withColumn("site", F.col("page_id") % 4)
    out = scratch.new_path(spark, "stream")
    st.discover_into(arriving, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema("site long, url string").parquet(f"{out}/rows")


@query("stream_monitor", """
    SELECT count(*) AS total, count(*) FILTER (WHERE status = 'IN_PROGRESS') AS active, count(*) FILTER (WHERE status = 'COMPLETED') AS completed,
      count(*) FILTER (WHERE status = 'FAILED') AS failed, round(sum(memory_mb), 4) AS memory_mb
    FROM (SELECT CASE event_type WHEN 'view' THEN 'QUEUED' WHEN 'click' THEN 'IN_PROGRESS' WHEN 'error' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
            value AS memory_mb, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events) WHERE back = 1""")
def _(spark, sf):
    kind = F.col("event_type")
    tasks = _stream(spark, sf, "events", tb.EVENTS).select(
        F.col("user_id").cast("string").alias("task_id"), "ts", "event_id", F.col("ts").alias("start_time"),
        F.when(~kind.isin("view", "click"), F.col("ts")).alias("end_time"),
        F.when(kind == "view", "QUEUED").when(kind == "click", "IN_PROGRESS").when(kind == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        F.col("value").alias("memory_mb"))
    out = scratch.new_path(spark, "stream")
    st.run_monitor(st.stream_monitor(tasks, ("ts", "event_id")), out, f"{out}/state")
    rows = spark.read.parquet(f"{out}/totals")
    newest = rows.agg(F.max("batch")).first()[0]
    return rows.filter(F.col("batch") == newest).drop("batch").withColumn("memory_mb", F.round("memory_mb", 4))


@query("stream_rate_audit", f"""SELECT * FROM ({_WINDOWS})
    WHERE epoch_us(window_end) // 600000000 * 600 + 600 <= (SELECT epoch_us(max(ts)) / 1000000 - 600 FROM events)""")
def _(spark, sf):
    log = _stream(spark, sf, "events", tb.EVENTS).select(F.col("ts").cast("timestamp").alias("ts"))
    out = scratch.new_path(spark, "stream")
    st.run_available(st.stream_rate_audit(log, limit=1), f"{out}/rows", f"{out}/state")
    rows = spark.read.schema("window_start timestamp, window_end timestamp, n_requests long").parquet(f"{out}/rows")
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                       F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_requests")


# -- sinks: written, then read back ----------------------------------------

@query("sink_report", """SELECT site, depth, concat('Depth Level ', depth) AS sheet, page_url, coalesce(image_url, '') AS image_url,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM report""")
def _(spark, sf):
    out = scratch.new_path(spark, "sink")
    sinks.sink_report(rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf)), out)
    return tb.read_report(spark, out).select("site", "depth", "sheet", "page_url", "image_url", "ts")


@query("sink_pages", "SELECT site, depth, url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM walked")
def _(spark, sf):
    out = scratch.new_path(spark, "sink")
    sinks.sink_pages(v.walked(spark, sf), out)
    return spark.read.parquet(out).select("site", "depth", "url", "ts")


@query("sink_summary", f"""
    SELECT s.*, coalesce(c.n, 0) AS n_crawled, coalesce(d.n, 0) AS n_discovered, coalesce(c.n, 0) + coalesce(d.n, 0) AS total_links,
      coalesce(i.n, 0) AS total_images, coalesce(j.n, 0) AS total_images_joined
    FROM ({_SUMMARY.format(crawled="walked", report="report")}) s
    LEFT JOIN (SELECT site, count(*) AS n FROM walked GROUP BY 1) c ON c.site = s.site
    LEFT JOIN (SELECT site, count(DISTINCT url) AS n FROM found GROUP BY 1) d ON d.site = s.site
    LEFT JOIN (SELECT site, count(*) AS n FROM walked_images GROUP BY 1) i ON i.site = s.site
    LEFT JOIN (SELECT site, count(image_url) AS n FROM report GROUP BY 1) j ON j.site = s.site""")
def _(spark, sf):
    out = scratch.new_path(spark, "sink")
    crawled, images = v.walked(spark, sf), v.walked_images(spark, sf)
    totals = rp.site_summary(crawled, fr.first_seen(v.found(spark, sf)), images)
    sinks.sink_summary(rp.depth_summary(crawled, images), out, totals=totals)
    return spark.read.parquet(out)


@query("sink_sections", """
    SELECT domain, section, href AS url, row_number() OVER (PARTITION BY domain, section ORDER BY href) AS pos, true AS indexed FROM section_folded""")
def _(spark, sf):
    out = scratch.new_path(spark, "sink")
    sinks.sink_sections(sc.sections(v.section_links(spark, sf), v.SUFFIXES), out)
    line = F.from_json("value", "domain string, section string, pos long, url string")
    lines = spark.read.text(f"{out}/lines").select(line.alias("line"), F.col("_metadata.file_name").alias("file")).select("line.*", "file")
    held = spark.read.parquet(f"{out}/index").withColumnRenamed("domain", "d").withColumnRenamed("file", "f")
    inside = (F.col("domain") == F.col("d")) & (F.col("file") == F.col("f"))
    indexed = F.coalesce(F.col("section").between(F.col("first_section"), F.col("last_section")), F.lit(False))
    return lines.join(held, inside, "left").select("domain", "section", "url", "pos", indexed.alias("indexed"))


@query("sink_embeddings", _FACES)
def _(spark, sf):
    out = scratch.new_path(spark, "sink")
    sinks.sink_embeddings(em.explode_faces(v.faces(spark, sf)), out)
    rows = em.embedding_array(tb.read_table(spark, out, "image_path string, face_index int, embedding string", "csv"))
    return rows.select("image_path", "face_index", _whole(F.col("embedding")).alias("vector"))


@query("sink_dedup", "SELECT group_no, rank, ord, action FROM ranked")
def _(spark, sf):
    out = scratch.new_path(spark, "sink")
    sinks.sink_dedup(dd.dedup(v.hashed_items(spark, sf)), out)
    kept, dropped = spark.read.parquet(f"{out}/keep"), spark.read.parquet(f"{out}/drop")
    return kept.unionByName(dropped).select("group_no", "rank", "ord", "action")
