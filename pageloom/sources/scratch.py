"""Intermediate tables that cut lineage and survive the loss of executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.session import scratch_root


def _folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/pageloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path in this application's scratch folder."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application.

    Results read from them until they are written elsewhere, so this comes last.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Columnar files are computed once, can be pruned by column and outlive any
    executor, which a row checkpoint or a cached block does not offer together.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_bucketed(df: DataFrame, keys: list[str], label: str = "table") -> DataFrame:
    """Like :func:`materialise`, hashed by ``keys`` and sorted within buckets.

    Later joins on ``keys`` read the table without an exchange or a sort.  The
    bucket count equals the shuffle width, so one task writes one bucket.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, label)
    name = f"pageloom_{label}_{uuid.uuid4().hex}"
    (
        df.repartition(n, *[F.col(k) for k in keys])
        .write.format("parquet")
        .option("path", path)
        .bucketBy(n, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the plan is resolved; only the files are needed
    return table
