"""Exact row numbers without one task per group.

``row_number() over (partition by k)`` sends a whole group to one task.  Groups
here can be a third of the data (one site, one depth, one pile of copies), so
the number is built from a range partitioning instead: rows are sorted across
tasks, each (group, slice) is counted, and a slice starts where the ones before
it end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.sources.scratch import materialise


def with_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """Add ``out`` = 1-based position within ``keys`` by ``order``.

    ``order`` has to be unique within a group.  The sorted rows are written
    once, because range bounds are sampled and must not be drawn again.  Adaptive
    execution may merge neighbouring slices of small inputs, which keeps order.
    """
    sort = [*[F.col(k) for k in keys], *[F.col(c) if isinstance(c, str) else c for c in order]]
    placed = materialise(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn("__place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("__slice", F.shiftright("__place", 33))

    ends = placed.groupBy(*keys, "__slice").agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    # one row per (group, slice): at most one slice per shuffle partition
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__slice").alias("__s"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    same = F.col("__slice") == F.col("__s")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    if keys:  # as many starts as groups: not for the driver to gather
        starts = starts.hint("merge")
    return placed.join(starts, same).select(
        *df.columns, (F.col("__place") + F.col("__shift")).cast("long").alias(out))
