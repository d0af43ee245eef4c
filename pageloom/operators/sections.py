"""Links of a domain grouped by the first segment of their path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.urls import path_section, with_url_parts
from pageloom.operators.domains import filter_internal, with_main_domain
from pageloom.operators.ranking import with_row_number


def distinct_links(links: DataFrame, order: str = "ord") -> DataFrame:
    """Links that differ by more than case, each in its first spelling."""
    return links.groupBy("domain", F.lower("href").alias("href_lower")).agg(F.min_by("href", order).alias("href"))


def group_by_section(links: DataFrame) -> DataFrame:
    """Add ``section``.  The lower-cased link decides, so spellings agree."""
    parts = with_url_parts(links, "href_lower", "__s_", ["path"])
    return parts.withColumn("section", path_section(F.col("__s_path"))).drop("__s_path")


def section_sizes(sectioned: DataFrame) -> DataFrame:
    return sectioned.groupBy("domain", "section").agg(F.count("*").alias("n_urls"))


def fold_singleton_sections(sectioned: DataFrame) -> DataFrame:
    """Move links that are alone in their section to ``root``.

    Section sizes are counted with partial aggregation and joined back, as a
    window would put a whole section into one task.
    """
    lone = section_sizes(sectioned).filter((F.col("n_urls") == 1) & (F.col("section") != "root"))
    marked = sectioned.join(lone.withColumn("__lone", F.lit(True)).drop("n_urls"), ["domain", "section"], "left")
    return marked.withColumn("section", F.when(F.col("__lone"), F.lit("root")).otherwise(F.col("section"))).drop("__lone")


def sections_sorted(folded: DataFrame) -> DataFrame:
    """``(domain, section, pos, url)``: position of each link in its sorted section."""
    rows = folded.select("domain", "section", F.col("href").alias("url"))
    return with_row_number(rows, ["domain", "section"], ["url"], "pos")


def sections(links: DataFrame, suffixes) -> DataFrame:
    """Sections of every domain: ``links(domain, ord, href)`` -> ``(domain, section, url)``.

    ``domain`` is the address the links belong to; only links on its main
    domain count.
    """
    own = filter_internal(with_main_domain(links, "domain", suffixes))
    return fold_singleton_sections(group_by_section(distinct_links(own))).select(
        "domain", "section", F.col("href").alias("url"))


def sections_json(rows: DataFrame) -> DataFrame:
    """``(domain, section, pos, json)``: one JSON object ``{domain, section, pos, url}`` for each link.

    ``pos`` is the link's place in its sorted section.  The shape is the same
    for a site of ten links and one of ten million.
    """
    placed = with_row_number(rows.select("domain", "section", "url"), ["domain", "section"], ["url"], "pos")
    return placed.select("domain", "section", "pos", F.to_json(F.struct("domain", "section", "pos", "url")).alias("json"))


def sections_document(rows: DataFrame) -> DataFrame:
    """``(domain, json)`` with ``{domain: {section: [urls]}}``, one row for each domain; a null is the key ``null``."""
    named = lambda c: F.coalesce(F.col(c), F.lit("null"))
    lists = rows.groupBy("domain", named("section").alias("section")).agg(F.array_sort(F.collect_list("url")).alias("urls"))
    nested = lists.groupBy("domain").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", "urls")))).alias("sections"))
    return nested.select("domain", F.to_json(F.create_map(named("domain"), "sections")).alias("json"))
