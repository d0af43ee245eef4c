"""Composite jobs over the derived views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators import frontier as fr
from pageloom.operators.dedup import dedup
from pageloom.operators.domains import with_main_domain
from pageloom.operators.embed import embed_images, embedding_json, explode_faces
from pageloom.operators.links import extract_links, normalized_links
from pageloom.operators.logs import fetch_outcome
from pageloom.operators.manifest import download_manifest
from pageloom.operators.report import join_pages_images
from pageloom.plans import views as v


def links_per_domain(pages: DataFrame, suffixes) -> DataFrame:
    """Distinct addresses linked from the pages of each main domain."""
    links = normalized_links(extract_links(pages))
    distinct = links.select("url").distinct()
    return with_main_domain(distinct, "url", suffixes).groupBy("main_domain").agg(F.count("*").alias("n_urls"))


def walk(spark: SparkSession, sf: str, limits=None, depth: int = v.WALK_DEPTH) -> fr.Crawl:
    return fr.crawl_frontier(
        v.seeds(spark, sf), v.site_pages(spark, sf).select("page_id", "url", "ts"), v.site_links(spark, sf),
        max_depth=depth, limits=limits, suffixes=v.SUFFIXES)


def cut_walk(spark: SparkSession, sf: str) -> fr.Crawl:
    return walk(spark, sf, v.LIMITS, 3)


def walk_images(spark: SparkSession, sf: str, crawl: fr.Crawl) -> DataFrame:
    return fr.harvest_images(crawl.crawled, v.pages(spark, sf), v.page_media(spark, sf))


def halves(batch: list) -> list:
    """Stand-in for a model: both halves of a vector that starts above zero, else none."""
    return [[list(x[:32]), list(x[32:])] if x[0] > 0 else [] for x in batch]


def attempts_by_depth(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes of the attempt log with the site and depth their request came from."""
    outcomes = fetch_outcome(v.attempt_log(spark, sf)).withColumn("site", F.regexp_extract("url", "^[a-z]+://[^/]+", 0))
    return outcomes.withColumn("depth", (F.substring_index("req_id", "-", 1).cast("long") % 5).cast("int"))


def full_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Walk, report and manifest; then deduplication and inference over stored images.

    One row per site and step with the number of rows it gave.
    """
    crawl = walk(spark, sf)
    images = walk_images(spark, sf, crawl)
    manifest = download_manifest(join_pages_images(crawl.crawled, images))
    kept = dedup(v.hashed_items(spark, sf)).filter("action = 'Retained'")
    stored = v.img_items(spark, sf).select("ord", F.col("px").alias("content"))
    chosen = stored.join(kept.select("ord").hint("merge"), "ord").select(F.col("ord").cast("string").alias("image_path"), "content")
    vectors = embedding_json(explode_faces(embed_images(chosen, halves, 32)))
    count = lambda df, step: df.agg(F.lit(step).alias("step"), F.count("*").alias("n"))
    return (
        count(crawl.crawled, "crawled").unionAll(count(images, "images")).unionAll(count(manifest, "manifest"))
        .unionAll(count(kept, "kept")).unionAll(count(vectors, "vectors"))
    )
