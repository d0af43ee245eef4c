"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.sources import scratch


def merged(table: DataFrame) -> DataFrame:
    """For the right side of a join: the driver gathers no table for a broadcast, however small it is.

    A search is more than a hundred joins, and each broadcast is a job, a thread
    that stays for a minute and pages in the driver, over any input.
    """
    return table.hint("merge")


def components(edges: DataFrame) -> DataFrame:
    """``(id, comp)`` of every id in ``edges (a, b)``; ``comp`` is the least id reached.

    Each step takes the least label among a node and its neighbours and then the
    label of that label, so stars settle in two steps and chains in about the
    logarithm of their length.  Every step is a table in the shared folder.
    """
    # Both directions of a row at once: a union would compute the edges twice.
    ends = edges.select(F.expr("inline(array(struct(a, b), struct(b as a, a as b)))"))
    both = scratch.materialise(ends.distinct(), "edges")
    labels = scratch.materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "id"), "labels")
    while True:
        # A node's own label goes with its neighbours': one sum instead of a sum and a join.
        near = both.join(merged(labels.select(F.col("id").alias("b"), F.col("comp").alias("near"))), "b").select(F.col("a").alias("id"), "near", F.lit(None).cast("long").alias("old"))
        own = labels.select("id", F.col("comp").alias("near"), F.col("comp").alias("old"))
        least = near.unionAll(own).groupBy("id").agg(F.min("near").alias("comp"), F.max("old").alias("old"))
        jump = labels.select(F.col("id").alias("comp"), F.col("comp").alias("jump"))
        step = least.join(merged(jump), "comp").select("id", F.least("comp", "jump").alias("comp"), "old")
        step = scratch.materialise(step, "labels")
        labels = step.select("id", "comp")
        if step.filter("comp <> old").isEmpty():
            return labels
