"""Writers for reports, summaries, sections, vectors and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.labels import depth_sheet, format_ts
from pageloom.operators.embed import embedding_json
from pageloom.operators.report import REPORT_ORDER
from pageloom.operators.sections import sections_json

_CSV = {"header": True, "escape": '"'}


def _options(fmt: str) -> dict:
    return _CSV if fmt == "csv" else {}


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Spread rows over files by range: small groups share a file, large ones span several."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def report_sheet(report: DataFrame) -> DataFrame:
    """Report rows as they are written: sheet name, text times, empty cells.

    The order columns leave as one sortable text, so any format can hold them.
    """
    return report.select(
        "site", "depth", depth_sheet(F.col("depth")).alias("sheet"), "page_url",
        F.coalesce("image_url", F.lit("")).alias("image_url"), format_ts(F.col("ts")).alias("ts"), *REPORT_ORDER)


def sink_report(report: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("site", "depth")) -> None:
    """One folder per site and depth, rows in report order."""
    rows = _placed(report_sheet(report), ["site", "depth", *REPORT_ORDER])
    if fmt == "csv":
        for c in ("trail", "image_trail"):
            rows = rows.withColumn(c, F.to_json(c))
    rows.write.mode("overwrite").partitionBy(*partition_by).format(fmt).options(**_options(fmt)).save(path)


def sink_pages(crawled: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("site", "depth")) -> None:
    """The report without images: address and time of every crawled page."""
    rows = _placed(crawled, ["site", "depth", "trail"]).select("site", "depth", "url", format_ts(F.col("ts")).alias("ts"))
    rows.write.mode("overwrite").partitionBy(*partition_by).format(fmt).options(**_options(fmt)).save(path)


def sink_summary(summary: DataFrame, path: str, fmt: str = "parquet", totals: DataFrame | None = None) -> None:
    """Depth and totals rows of every site, each with the site's ``totals`` where they are given."""
    if totals is not None:
        summary = summary.join(totals, "site", "left")
    _placed(summary, ["site", "depth"]).write.mode("overwrite").format(fmt).options(**_options(fmt)).save(path)


def sink_sections(sections: DataFrame, path: str) -> None:
    """JSON lines in order of domain, section and link under ``lines``, and where each domain is under ``index``.

    Small domains share a file, large ones go on in the next.  The index has
    ``(domain, file, n_lines, first_section, last_section)``.
    """
    spark = sections.sparkSession
    _placed(sections_json(sections), ["domain", "section", "pos"]).select(F.col("json").alias("value")).write.mode("overwrite").text(f"{path}/lines")
    lines = spark.read.text(f"{path}/lines").select(
        F.get_json_object("value", "$.domain").alias("domain"), F.get_json_object("value", "$.section").alias("section"),
        F.col("_metadata.file_name").alias("file"))
    index = lines.groupBy("domain", "file").agg(
        F.count("*").alias("n_lines"), F.min("section").alias("first_section"), F.max("section").alias("last_section"))
    _placed(index, ["domain", "file"]).write.mode("overwrite").parquet(f"{path}/index")


def sink_embeddings(rows: DataFrame, path: str) -> bool:
    """Vectors as CSV with a header; no rows, no file."""
    if rows.isEmpty():
        return False
    embedding_json(rows).write.mode("overwrite").options(**_CSV).csv(path)
    return True


def sink_dedup(acted: DataFrame, path: str) -> None:
    """Keep table, drop table and group report under ``path``."""
    kept = F.col("action") == "Retained"
    acted.filter(kept).write.mode("overwrite").parquet(f"{path}/keep")
    acted.filter(~kept).write.mode("overwrite").parquet(f"{path}/drop")
    _placed(acted, ["group_no", "rank"]).write.mode("overwrite").parquet(f"{path}/groups")
