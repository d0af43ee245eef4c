"""Views derived from the given tables.

The raw pages link nowhere, so walks, images and logs run over views computed
from ``pages``, ``embeddings`` and ``events``.  They grow with those tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.hashes import average_hash, perceptual_hash
from pageloom.operators.frontier import harvest_images
from pageloom.operators.links import extract_links, normalized_links
from pageloom.operators.ranking import with_row_number
from pageloom.sources.tables import EVENTS, PAGES, read_table

SUFFIXES = ["com", "net", "org", "test", "co.uk", "uk"]
SOCIAL = ["elsewhere.test", "example.org"]
LIMITS = [None, 2, None, 4]
WALK_DEPTH = 5
SITES = 4


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/pages.parquet", PAGES)


def events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/events.parquet", EVENTS)


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/embeddings.parquet", "vec_id long, embedding array<float>, label int")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def site_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Four sites; page ``k`` of site ``page_id % 4``, captured at ``ts``."""
    page_id = F.col("page_id")
    site, k = page_id % SITES, F.floor(page_id / SITES)
    return pages(spark, sf).select(
        "page_id", site.alias("site_no"), k.alias("k"),
        _text("https://www.site", site, ".test/en/", k).alias("url"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, page_id)").alias("ts"))


def site_links(spark: SparkSession, sf: str) -> DataFrame:
    """Per page three children, the parent and one link per filter rule."""
    k = F.col("k")
    root = _text("https://www.site", F.col("site_no"), ".test")
    hrefs = F.array(
        _text("/en/", 3 * k + 1),
        _text("/EN/", 3 * k + 2, "/"),
        _text(root, "/en/", 3 * k + 3, "?page=2#top"),
        _text(F.upper(root), "/en/", F.floor((k + 2) / 3) - 1),
        F.lit("/img/logo.png"), F.lit("/login"), F.lit("https://other.elsewhere.test/x"), F.lit("#top"))
    return site_pages(spark, sf).select("page_id", F.posexplode(hrefs).alias("pos", "href"))


def page_media(spark: SparkSession, sf: str) -> DataFrame:
    """None to two images per page, every form of ``src``."""
    page_id = F.col("page_id")

    def src(pos: Column) -> Column:
        form = (page_id + pos) % 6
        return (
            F.when(form == 0, _text("/static/", page_id, ".jpg"))
            .when(form == 1, _text("//cdn.elsewhere.test/", page_id, ".png"))
            .when(form == 2, _text("thumbs/", page_id, ".webp"))
            .when(form == 3, "https://www.site0.test/static/shared.jpg")
            .when(form == 4, "")
            .otherwise(_text("../up/", page_id, ".jpeg"))
        )

    both = F.slice(F.array(src(F.lit(0)), src(F.lit(1))), F.lit(1), (page_id % 3).cast("int"))
    return pages(spark, sf).select("page_id", F.posexplode(both).alias("pos", "src"))


def raw_links(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors of the raw pages: ``(page_id, page_url, pos, href)``."""
    return extract_links(pages(spark, sf))


def link_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Every raw link in ten spellings: ``(page_id, pos, form, href, page_url)``."""
    h = F.col("href")
    forms = F.array(
        h, F.lit("#top"), _text("?z=", F.col("pos")), _text("..", h, "?p=1"),
        _text("HTTPS://X.com", h, "?B=2&a=1&b=9&page=3&c=&a=0&e=", F.substr(h, F.lit(2)), "#t"),
        _text("/img", h), _text(h, ".JPG"), _text("mailto:me@", F.substr(h, F.lit(2))),
        _text("http://y.com", h, ";P=1?q=a%20b+c&Q=%zz~*&s=/"), _text(".", h, "/./x/../y//"))
    return raw_links(spark, sf).select("page_id", "page_url", "pos", F.posexplode(forms).alias("form", "href"))


def seeds(spark: SparkSession, sf: str) -> DataFrame:
    """The first page of every site."""
    return site_pages(spark, sf).filter("k = 0").select(F.col("site_no").alias("ord"), F.col("url").alias("domain"))


def messy_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """A seed list as people keep it: padded, with gaps and repeats."""
    n = F.col("page_id")
    return pages(spark, sf).select(
        n.alias("ord"),
        F.when(n % 5 == 0, None).when(n % 5 == 1, _text(" \t", F.col("url"), " \n"))
        .when(n % 5 == 2, "https://www.site0.test/en/0").otherwise(F.col("url")).alias("domain"))


def task_log(spark: SparkSession, sf: str) -> DataFrame:
    kind, n, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    return events(spark, sf).select(
        _text("task-", n, "-", user).alias("task_id"),
        _text("https://www.site", user % 4, ".test/en/section/subsection/", n).alias("url"),
        F.when(kind == "view", "QUEUED").when(kind == "click", "IN_PROGRESS")
        .when(kind == "error", "FAILED").otherwise("COMPLETED").alias("status"),
        F.col("value").alias("memory_mb"), (F.col("value") * 2).alias("peak_mb"), F.col("ts").alias("start_time"),
        F.when(~kind.isin("view", "click"), F.col("ts")).alias("end_time"),
        F.when((kind == "error") & (n % 2 == 0), _text("navigation failed while loading resource number ", n))
        .alias("error_message"))


def attempt_log(spark: SparkSession, sf: str) -> DataFrame:
    """Up to three attempts per request: three events in a row of one user."""
    kind, n, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    ranked = with_row_number(events(spark, sf).drop("props"), ["user_id"], ["ts", "event_id"], "rn")
    place = F.col("rn") - 1
    return ranked.select(
        _text(user, "-", F.floor(place / 3)).alias("req_id"),
        _text("https://www.site", user % 4, ".test/static/", user, ".jpg").alias("url"),
        (place % 3).cast("int").alias("attempt"), "ts",
        F.when(kind == "view", 200).when(kind == "click", 429).when(kind == "purchase", 503).alias("status"),
        F.when(kind == "error", "timeout").when(kind == "signup", "connect").alias("error"),
        F.when((kind == "click") & (n % 2 == 0), (n % 7).cast("int")).alias("retry_after"))


def img_items(spark: SparkSession, sf: str) -> DataFrame:
    """Three near copies of every vector, as 8x8 grey arrays; a fifth of them exact copies."""
    v = F.col("vec_id")
    copies = embeddings(spark, sf).select("vec_id", "embedding", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("c"))
    c = F.col("c")
    shift = F.when(v % 5 == 0, F.lit(0.0)).otherwise(F.lit(0.01) * c)
    px = F.transform("embedding", lambda x, i: x.cast("double") + shift * F.when((i + v) % 7 == 0, 1).otherwise(-1))
    return copies.select(
        (v * 3 + c).alias("ord"), px.alias("px"), (1000 + (v * 7919 + c * 104729) % 50000).alias("size_bytes"),
        (100 + (v * 31 + c * 17) % 600).alias("width"), (80 + (v * 13 + c * 29) % 500).alias("height"))


def hashed_items(spark: SparkSession, sf: str) -> DataFrame:
    """``img_items`` with their two hashes instead of pixels."""
    return img_items(spark, sf).select(
        "ord", perceptual_hash(F.col("px"), 8).alias("phash"), average_hash(F.col("px")).alias("ahash"),
        "size_bytes", "width", "height")


def vector_images(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors standing in for image contents: ``(image_path, content)``."""
    return embeddings(spark, sf).select(
        _text("img/", F.col("vec_id"), F.when(F.col("label") % 2 == 0, ".JPG").otherwise(".webp")).alias("image_path"),
        F.col("embedding").alias("content"))


def faces(spark: SparkSession, sf: str) -> DataFrame:
    """``(image_path, faces)``: up to three vectors per image, none for every fifth."""
    i = F.floor(F.col("vec_id") / 3)
    rows = embeddings(spark, sf).groupBy(i.alias("i")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda s: s["embedding"]).alias("all"))
    none = F.array().cast("array<array<float>>")
    return rows.select(
        _text("img/", F.col("i"), ".jpg").alias("image_path"),
        F.when(F.col("i") % 5 == 0, none).otherwise(F.col("all")).alias("faces"))


def walked(spark: SparkSession, sf: str) -> DataFrame:
    """A finished walk by rule: depth is the length of ``k``; every 50th page is walked twice."""
    p = site_pages(spark, sf)
    depth = F.length(F.col("k").cast("string")) - 1
    depths = F.when(F.col("k") % 50 == 0, F.array(depth, depth + 1)).otherwise(F.array(depth))
    return p.select(
        _text("https://www.site", F.col("site_no"), ".test").alias("site"), "url", F.explode(depths).alias("depth"),
        F.array(F.col("k").cast("int")).alias("trail"), "page_id", "ts")


def walked_images(spark: SparkSession, sf: str) -> DataFrame:
    return harvest_images(walked(spark, sf), pages(spark, sf), page_media(spark, sf))


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """``site_links`` with the address of their page."""
    own = site_pages(spark, sf).select("page_id", "site_no", F.col("url").alias("page_url"))
    return site_links(spark, sf).join(own, "page_id")


def found(spark: SparkSession, sf: str) -> DataFrame:
    """Every link occurrence of every site: ``(site, url, trail)``."""
    links = normalized_links(page_links(spark, sf))
    return links.select(
        _text("https://www.site", F.col("site_no"), ".test").alias("site"), "url",
        F.array(F.col("page_id").cast("int"), "pos").alias("trail"))


def section_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of the raw pages made absolute, in two spellings, per domain of the page: ``(domain, ord, href)``.

    Long words are nested under their first letter, so sections of many sizes appear.
    """
    h = F.substr("href", F.lit(2))
    nested = F.when(F.length("href") > 5, _text("/", F.left(h, F.lit(1)), "/", h)).otherwise(F.col("href"))
    root = F.regexp_extract("page_url", "^[a-z]+://[^/]+", 0)
    spelled = F.when(F.col("page_id") % 3 == 0, F.upper(nested)).otherwise(nested)
    target = F.when(F.col("pos") == 3, "https://not.other.test/x").when(F.col("pos") == 5, F.col("href")).otherwise(F.concat(root, spelled))
    return raw_links(spark, sf).select(
        root.alias("domain"), (F.col("page_id") * 1000 + F.col("pos")).alias("ord"), target.alias("href"))
