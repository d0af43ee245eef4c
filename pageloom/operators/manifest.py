"""Numbered list of images to download, from report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed
from pageloom.functions.labels import depth_sheet, extract_depth, is_depth_sheet, manifest_folder, manifest_name, site_part
from pageloom.operators.ranking import with_row_number
from pageloom.operators.report import REPORT_ORDER


def scan_report(rows: DataFrame) -> DataFrame:
    """Rows of sheets whose name starts with ``depth level``; no image column, no rows."""
    kept = rows.filter(is_depth_sheet(F.col("sheet")))
    return kept if "image_url" in rows.columns else kept.limit(0)


def filter_manifest(rows: DataFrame) -> DataFrame:
    """Rows with an image address; an empty cell counts as none."""
    return rows.filter(F.length("image_url") > 0)


def manifest_rownum(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Spreadsheet row of every report row: the header is row 1."""
    return with_row_number(rows, keys, order, "__n").withColumn("row_num", F.col("__n") + 1).drop("__n")


def download_manifest(report_rows: DataFrame, base_folder: str = fixed.BASE_FOLDER,
                      order: Sequence[str] = tuple(REPORT_ORDER)) -> DataFrame:
    """``(site, depth, row_num, url, filename, folder)`` of every image to fetch.

    Rows are numbered over the whole sheet before empty ones go.  The folder
    names the site, so no two images share a target.
    """
    if "sheet" not in report_rows.columns:
        report_rows = report_rows.withColumn("sheet", depth_sheet(F.col("depth")))
    numbered = manifest_rownum(scan_report(report_rows), ["site", "sheet"], order)
    depth = extract_depth(F.col("sheet"))
    return filter_manifest(numbered).select(
        "site", depth.alias("depth"), "row_num", F.col("image_url").alias("url"),
        F.concat(manifest_name(F.col("row_num"), depth), F.lit(".jpg")).alias("filename"),
        manifest_folder(F.concat_ws("/", site_part(F.col("site")), "sheet"), base_folder).alias("folder"))


def manifest_count(manifest: DataFrame) -> DataFrame:
    """Images per site and depth, per site with a null depth, and in all with both null."""
    return manifest.rollup("site", "depth").agg(F.count("*").alias("n_attempted"))


def download_count(outcomes: DataFrame) -> DataFrame:
    """Files obtained per site and depth, from ``fetch_outcome`` rows with both."""
    return outcomes.groupBy("site", "depth").agg(F.count_if(F.col("outcome") == "saved").alias("n_saved"))
