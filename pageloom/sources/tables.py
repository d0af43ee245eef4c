"""Readers with explicit schemas, and seed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.labels import is_depth_sheet
from pageloom.operators.ranking import with_row_number

PAGES = "page_id long, url string, html string"
SEEDS = "ord long, domain string"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
TASKS = ("task_id string, url string, status string, memory_mb double, peak_mb double, "
         "start_time timestamp, end_time timestamp, error_message string")
ATTEMPTS = "req_id string, url string, attempt int, ts timestamp, status int, error string, retry_after int"
REPORT = "sheet string, ord long, page_url string, image_url string, ts string"

_READERS = {"parquet": {}, "orc": {}, "json": {}, "csv": {"header": True, "escape": '"', "multiLine": True}}


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Read a file or folder with a stated schema; nothing is inferred."""
    if fmt not in _READERS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {sorted(_READERS)}")
    return spark.read.format(fmt).schema(schema).options(**_READERS[fmt]).load(path)


def strip(text: Column) -> Column:
    """Remove all surrounding whitespace, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def scan_seeds(seeds: DataFrame) -> DataFrame:
    """``(ord, domain)``: null entries go, the rest is stripped; order and repeats stay."""
    return seeds.filter("domain is not null").select("ord", strip(F.col("domain")).alias("domain"))


def select_seeds(seeds: DataFrame, request: str) -> DataFrame:
    """Seeds named by ``'all'`` or by comma-separated numbers counted from 1.

    The order of the request is kept and repeats are allowed.  A number outside
    the list, or no number at all, is an error.
    """
    numbered = with_row_number(scan_seeds(seeds), [], ["ord"], "number")
    if request.strip().lower() == "all":
        return numbered.select(F.col("number").alias("pos"), "domain")
    try:
        wanted = [int(part) for part in request.split(",")]
    except ValueError:
        raise ValueError("seed numbers must be integers separated by commas, or 'all'") from None
    asked = seeds.sparkSession.createDataFrame(list(enumerate(wanted, 1)), "pos long, number long")
    missing = sorted(r.number for r in asked.join(numbered, "number", "left_anti").select("number").distinct().collect())
    if missing:
        raise ValueError(f"no seed with number {', '.join(map(str, missing))}")
    return asked.join(numbered, "number").select("pos", "domain").orderBy("pos")


def read_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Report sheets written by ``sink_report``; sheets of other names are left out."""
    rows = spark.read.format(fmt).options(**_READERS[fmt]).load(path)
    if "image_url" not in rows.columns:
        return rows.limit(0)
    if "sheet" in rows.columns:
        rows = rows.filter(is_depth_sheet(F.col("sheet")))
    return rows
