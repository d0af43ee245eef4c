"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", name: str = "pageloom") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{tempfile.gettempdir()}/pageloom-scratch")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; without that setting the
    warehouse, which executors share as well, holds it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return root.rstrip("/")
