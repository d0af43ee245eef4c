"""Breadth-first walk over a page snapshot, all sites at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed
from pageloom.functions.urls import with_normalized_url
from pageloom.operators.domains import exclude_social, keep_same_domain
from pageloom.operators.links import absolute_images, extract_images, extract_links, extract_tags, filter_image_src, normalized_links, split_tags
from pageloom.operators.ranking import with_row_number
from pageloom.sources.scratch import materialise, materialise_bucketed

# Links of one page are stored in blocks of this many, so that a page with very
# many links spreads over buckets.
LINK_BLOCK = 10_000


@dataclass(frozen=True)
class Snapshot:
    """Captured pages prepared for walking.

    ``pages`` is ``(key, page_id, ts, last_block)``, one page per address, kept
    by ``key``; ``edges`` is ``(page_id, block, pos, link)`` kept by
    ``(page_id, block)``; ``media`` is ``(page_id, pos, src)`` where images were
    asked for.
    """

    pages: DataFrame
    edges: DataFrame
    media: DataFrame | None = None


@dataclass(frozen=True)
class Crawl:
    """``discovered(site, url, depth, trail)`` and ``crawled(site, url, depth, trail, page_id, ts)``.

    ``frontier`` holds every queued address with ``depth``.  ``trail`` is the
    list of link positions that led to an address first; within one depth it
    sorts in discovery order.
    """

    frontier: DataFrame
    discovered: DataFrame
    crawled: DataFrame


def page_key(df: DataFrame, url: str, out: str) -> DataFrame:
    """The key two addresses of one page share: their normal form."""
    return with_normalized_url(df, url, url, out).withColumn(out, F.coalesce(out, url))


def build_snapshot(pages: DataFrame, links: DataFrame | None = None, *, suffixes=None, social=None, same_site: bool = True,
                   images: bool = False, **options) -> Snapshot:
    """Normalise pages and links once, before the walk.

    ``pages`` is ``(page_id, url, html)`` with an optional ``ts``.  ``links``
    ``(page_id, pos, href)`` replaces extraction from ``html``.  Links that leave
    the site go: another main domain with ``suffixes``, another host without;
    ``same_site=False`` keeps them.  ``images`` keeps the images of every page
    too: ``html`` is read once for both, and what it holds is stored.
    """
    if "ts" not in pages.columns:
        pages = pages.withColumn("ts", F.lit(None).cast("timestamp"))
    media = extract_images(pages, ["page_id"]).select("page_id", "pos", "src") if images and links is not None else None
    if links is None and images:
        found, media = split_tags(materialise(extract_tags(pages), "tags"))
        media = media.select("page_id", "pos", "src")
    elif links is None:
        found = extract_links(pages)
    else:
        # merge hints: a table that grows with the pages is never gathered in the driver, however small its files are
        found = links.join(pages.select("page_id", F.col("url").alias("page_url")).hint("merge"), "page_id")
    edges = normalized_links(found, **options)
    if same_site:
        edges = keep_same_domain(edges, "url", "page_url", () if suffixes is None else suffixes)
    if social is not None:
        edges = exclude_social(edges, social, "url", () if suffixes is None else suffixes)
    edges = materialise_bucketed(
        edges.select("page_id", F.floor(F.col("pos") / LINK_BLOCK).cast("int").alias("block"),
                     F.col("pos").cast("int").alias("pos"), F.col("url").alias("link")),
        ["page_id", "block"], "edges")

    blocks = edges.groupBy("page_id").agg(F.max("block").alias("last_block"))
    one_each = (
        page_key(pages.select("page_id", "url", "ts"), "url", "key")
        .groupBy("key").agg(F.min("page_id").alias("page_id"), F.min_by("ts", "page_id").alias("ts"))
    )
    table = materialise_bucketed(one_each.join(blocks.hint("merge"), "page_id", "left"), ["key"], "pages")
    return Snapshot(table, edges, media)


def level_limits(limits, max_depth: int) -> list[int | None]:
    """Limits per depth as a list; depth 0 and unset depths are unlimited."""
    if isinstance(limits, DataFrame):
        wanted = limits.filter(F.col("depth").between(0, max_depth))
        rows = wanted.groupBy("depth").agg(F.collect_set(F.coalesce(F.col("max_urls").cast("string"), F.lit("all"))).alias("values")).collect()
        if torn := sorted(r["depth"] for r in rows if len(r["values"]) > 1):
            raise ValueError(f"conflicting limits for depth {', '.join(map(str, torn))}")
        by_depth = {r["depth"]: "all" if r["values"][0] == "all" else int(r["values"][0]) for r in rows}
    else:
        by_depth = dict(enumerate(limits or []))
    by_depth[0] = None
    listed = [by_depth.get(d) for d in range(max_depth + 1)]
    listed = [None if n == "all" else n for n in listed]
    if any(n is not None and (not isinstance(n, int) or n < 1) for n in listed):
        raise ValueError("a level limit is 'all', None or a positive number")
    return listed


def limit_per_depth(level: DataFrame, max_urls: int | None, order: str = "trail") -> DataFrame:
    """First ``max_urls`` rows of each site in discovery order."""
    if max_urls is None:
        return level
    return with_row_number(level, ["site"], [order], "__n").filter(F.col("__n") <= max_urls).drop("__n")


def first_seen(candidates: DataFrame) -> DataFrame:
    """Of equal addresses of a site keep the earliest discovery."""
    return candidates.groupBy("site", "url").agg(F.min("trail").alias("trail"))


def anti_visited(new: DataFrame, seen: DataFrame) -> DataFrame:
    """New addresses that were not seen before."""
    return new.join(seen.select("site", "url"), ["site", "url"], "left_anti")


def fetch_pages(level: DataFrame, pages: DataFrame) -> DataFrame:
    """Queued addresses that the snapshot holds."""
    return level.join(pages, "key")


def fetch_failures(level: DataFrame, pages: DataFrame) -> DataFrame:
    """Queued addresses that the snapshot lacks."""
    return level.join(pages.select("key"), "key", "left_anti")


def follow(crawled: DataFrame, edges: DataFrame) -> DataFrame:
    """Links of crawled pages: ``(site, url, trail)``."""
    blocks = crawled.filter("last_block is not null").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("last_block"))))
    return blocks.select("site", "page_id", "block", "trail").join(edges, ["page_id", "block"]).select(
        "site", F.col("link").alias("url"), F.concat("trail", F.array("pos")).alias("trail"))


def seed_level(seeds: DataFrame) -> DataFrame:
    """Depth 0: one row per distinct seed, with an empty trail."""
    level = seeds.filter("domain is not null").select(F.col("domain").alias("site"), F.col("domain").alias("url")).distinct()
    return page_key(level, "url", "key").withColumn("trail", F.array().cast("array<int>"))


def crawl_frontier(
    seeds: DataFrame,
    pages: DataFrame | Snapshot,
    links: DataFrame | None = None,
    *,
    max_depth: int = fixed.MAX_DEPTH,
    limits: DataFrame | Sequence[int | str | None] | None = None,
    mark_seed: bool = False,
    **options,
) -> Crawl:
    """Walk every site of ``seeds(ord, domain)`` level by level.

    One set of jobs per depth, whatever the number of sites.  Addresses found
    at the last depth count as discovered and are not walked.  Seeds are not
    marked as seen unless ``mark_seed``, so a link back to one walks it again.
    """
    limit_at = level_limits(limits, max_depth)
    snapshot = pages if isinstance(pages, Snapshot) else build_snapshot(pages, links, **options)
    level = materialise(seed_level(seeds), "level")
    queued = [level.withColumn("depth", F.lit(0))]
    found: list[DataFrame] = []
    walked: list[DataFrame] = []
    for depth, max_urls in enumerate(limit_at):
        crawled = materialise(fetch_pages(limit_per_depth(level, max_urls), snapshot.pages), "crawled")
        walked.append(crawled.withColumn("depth", F.lit(depth)))
        new = first_seen(follow(crawled, snapshot.edges))
        if mark_seed:
            new = anti_visited(new, queued[0].select("site", F.col("key").alias("url")))
        # one anti-join per earlier level: all are kept by (site, url), so only
        # the new rows move
        new = reduce(anti_visited, found, new)
        level = materialise_bucketed(new, ["site", "url"], "level").withColumn("key", F.col("url"))
        found.append(level.withColumn("depth", F.lit(depth + 1)))
        queued.append(found[-1])
        if level.isEmpty():
            break
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return Crawl(
        union(queued[: len(limit_at)]).select("site", "url", "depth", "trail", "key"),
        union(found).select("site", "url", "depth", "trail"),
        union(walked).select("site", "url", "depth", "trail", "page_id", "ts"),
    )


def with_ord(df: DataFrame) -> DataFrame:
    """Add ``ord``: position within (site, depth) in discovery order."""
    return with_row_number(df, ["site", "depth"], ["trail"], "ord")


def batch_number(ranked: DataFrame, size: int = fixed.BATCH_SIZE, ord_col: str = "ord") -> DataFrame:
    """Cut numbered level rows into batches of ``size``, counted from 1."""
    if size < 1:
        raise ValueError("batch size must be positive")
    return ranked.withColumn("batch", F.floor((F.col(ord_col) - 1) / size).cast("long") + 1)


def limits_table(spark, limits: Sequence[int | str | None], max_depth: int) -> DataFrame:
    rows = list(enumerate(level_limits(limits, max_depth)))
    return spark.createDataFrame(rows, "depth int, max_urls int")


def with_limit(level: DataFrame, limits: DataFrame) -> DataFrame:
    """Addresses of a level with the ``max_urls`` of their depth; null is no limit."""
    return level.join(limits, "depth", "left")


def with_result(level: DataFrame, pages: DataFrame) -> DataFrame:
    """Addresses with the ``page_id`` of their page and ``success``, paired by address."""
    table = page_key(pages, "url", "key").select("key", "page_id")
    return level.withColumn("key", F.col("url")).join(table, "key", "left").drop("key").withColumn(
        "success", F.col("page_id").isNotNull())


def union_levels(crawled: DataFrame, discovered: DataFrame) -> DataFrame:
    """``(site, url, kind)`` of what was walked and of what was found."""
    part = lambda df, kind: df.select("site", "url", F.lit(kind).alias("kind"))
    return part(crawled, "crawled").unionByName(part(discovered, "discovered"))


def visited(found: DataFrame) -> DataFrame:
    """Each address of a site once."""
    return found.select("site", "url").distinct()


def level_stats(frontier: DataFrame, limits: DataFrame, size: int = fixed.BATCH_SIZE) -> DataFrame:
    """Per site and depth: addresses found, limit, addresses taken, batches."""
    if size < 1:
        raise ValueError("batch size must be positive")
    found = frontier.groupBy("site", "depth").agg(F.count("*").alias("n_found"))
    taken = F.least("n_found", F.col("max_urls").cast("long"))  # least skips null
    return found.join(limits, "depth", "left").select(
        "site", "depth", "n_found", "max_urls", taken.alias("n_taken"),
        F.ceil(taken / size).cast("long").alias("n_batches"))


def harvest_images(crawled: DataFrame, pages: DataFrame | Snapshot, media: DataFrame | None = None) -> DataFrame:
    """Images of every crawled page, absolute against the requested address.

    ``media(page_id, pos, src)`` replaces extraction from ``html``, as does a
    snapshot built with ``images=True``.  A page walked twice gives its images
    twice.
    """
    if isinstance(pages, Snapshot):
        media = pages.media if media is None else media
        if media is None:
            raise ValueError("the snapshot holds no images: build it with images=True")
    if media is None:
        media = extract_images(pages, ["page_id"])
    media = filter_image_src(media.select("page_id", "pos", "src"))
    rows = crawled.withColumnRenamed("url", "page_url").join(media, "page_id")
    return project_images(absolute_images(rows))


def project_images(rows: DataFrame) -> DataFrame:
    return rows.select("site", "image_url", "page_url", "ts", "depth", "trail", "pos")


def project_crawled(crawled: DataFrame) -> DataFrame:
    return crawled.select("site", "depth", "url", "ts")
