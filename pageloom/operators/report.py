"""Pages with their images, and counts per depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.labels import depth_label

REPORT_ORDER = ["trail", "image_depth", "image_trail", "pos"]


def join_pages_images(crawled: DataFrame, images: DataFrame) -> DataFrame:
    """Each crawled page with each of its images; pages without any give one row.

    Images are matched by page address alone, so a page walked at two depths
    shows all of them at both.  A key holds one page's images, so one left join
    does: images are read once, and a page walked by many is split on its side.
    """
    page = crawled.select("site", "depth", "trail", F.col("url").alias("page_url"), F.col("ts").alias("page_ts"))
    image = images.select(
        "site", "page_url", "image_url", F.col("ts").alias("image_ts"),
        F.col("depth").alias("image_depth"), F.col("trail").alias("image_trail"), "pos")
    joined = page.join(image, ["site", "page_url"], "left").withColumn("ts", F.coalesce("image_ts", "page_ts"))
    return joined.select("site", "depth", "page_url", "image_url", "ts", *REPORT_ORDER)


def images_per_page(images: DataFrame) -> DataFrame:
    return images.groupBy("site", "page_url").agg(F.count("*").alias("n_images"))


def _counted_pages(crawled: DataFrame, images: DataFrame) -> DataFrame:
    """Crawled pages with their image count; counting comes before the join."""
    per_page = images_per_page(images).withColumnRenamed("page_url", "url")
    return crawled.select("site", "url", "depth").join(per_page, ["site", "url"], "left")


def urls_per_depth(crawled: DataFrame) -> DataFrame:
    return crawled.groupBy("site", "depth").agg(F.count("*").alias("n_urls"))


def images_per_depth(crawled: DataFrame, images: DataFrame) -> DataFrame:
    """Joined image rows per depth, 0 when there are none."""
    return _counted_pages(crawled, images).groupBy("site", "depth").agg(
        F.coalesce(F.sum("n_images"), F.lit(0)).alias("n_images"))


def depth_summary(crawled: DataFrame, images: DataFrame) -> DataFrame:
    """Pages and images per depth with a totals row per site, in depth order."""
    counts = (
        _counted_pages(crawled, images)
        .groupBy("site", "depth")
        .agg(F.count("*").alias("n_urls"), F.coalesce(F.sum("n_images"), F.lit(0)).alias("n_images"))
    )
    totals = (
        counts.rollup("site", "depth")
        .agg(F.sum("n_urls").alias("n_urls"), F.sum("n_images").alias("n_images"), F.grouping_id().alias("__g"))
        .filter(F.col("__g") < 3)
    )
    label = F.when(F.col("__g") == 0, depth_label(F.col("depth"))).otherwise(F.lit("Total"))
    return totals.select("site", "depth", label.alias("label"), "n_urls", "n_images").orderBy(
        "site", F.col("depth").asc_nulls_last())


def total_links(crawled: DataFrame, discovered: DataFrame) -> DataFrame:
    """Crawled visits plus discovered addresses, with both parts."""
    a = crawled.groupBy("site").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("m"))
    b = discovered.groupBy("site").agg(F.lit(0).cast("long").alias("n"), F.count("*").alias("m"))
    both = a.unionByName(b).groupBy("site").agg(F.sum("n").alias("n_crawled"), F.sum("m").alias("n_discovered"))
    return both.withColumn("total_links", F.col("n_crawled") + F.col("n_discovered"))


def total_images(images: DataFrame) -> DataFrame:
    """All image rows of a site, before they are joined to pages."""
    return images.groupBy("site").agg(F.count("*").alias("total_images"))


def total_images_joined(crawled: DataFrame, images: DataFrame) -> DataFrame:
    return images_per_depth(crawled, images).groupBy("site").agg(F.sum("n_images").alias("total_images_joined"))


def crawled_pages(crawled: DataFrame) -> DataFrame:
    return crawled.groupBy("site").agg(F.count("*").alias("crawled_pages"))


def site_summary(crawled: DataFrame, discovered: DataFrame, images: DataFrame) -> DataFrame:
    """Totals of each site: crawled, discovered, links, images, joined images."""
    out = total_links(crawled, discovered)
    for part in (total_images(images), total_images_joined(crawled, images)):
        out = out.join(part, "site", "left")
    return out.fillna(0, ["total_images", "total_images_joined"])
