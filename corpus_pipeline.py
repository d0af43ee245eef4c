"""From documents to a sharded, mixed, clean corpus, in stages written one after another.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import decontaminate, jaccard_join, mixing, quality_gam, queries, sharding
from pageloom.sources import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_gam.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal or near texts the document with the least id stays."""
    return jaccard_join.keep_first(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of the target weights; one taken in two epochs appears twice, one taken in part stays whole."""
    packed = docs.select("doc_id", "text", "lang", "source", F.struct("*").alias("document"))
    mixed = mixing.mix(queries.with_domain(packed), queries.WEIGHTS, carry=("document",))
    return mixed.select("row.document.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", clean_of_benchmarks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: No SQL states the classifier's model or the seeded orders; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
