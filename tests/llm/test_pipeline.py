"""Every stage of the pipeline against a brute-force version of its decision."""

from collections import Counter

import brute
import corpus_pipeline
from pageloom.llm import quality_gam, queries
from pageloom.sources import scratch
from pyspark.sql import functions as F


def test_stages(spark, sf):
    docs = queries.table(spark, sf, "documents")
    bench = [brute.shingles(r.text) for r in queries.table(spark, sf, "benchmark").collect() if len(brute.words(r.text)) >= 5]
    good = {r.doc_id for r in quality_gam.classify(docs, queries.table(spark, sf, "labels")).collect() if r.predicted == 1}
    text = {r.doc_id: r.text for r in docs.collect()}
    want, seen = good, []
    for name, stage in corpus_pipeline.STAGES:
        after = scratch.materialise(stage(spark, docs, sf), "stage")
        ids = [r.doc_id for r in after.select("doc_id").collect()]
        if name == "n-gram Jaccard join":
            want = set(brute.classes({d: text[d] for d in want})[0].values())
        elif name == "benchmark decontamination":
            want = {d for d in want if not any(len(q & brute.shingles(text[d])) >= 0.8 * len(q) for q in bench)}
        if name.startswith("mixing"):
            assert set(ids) <= want and max(Counter(ids).values()) <= 2 and len(set(ids)) < len(want)
        elif name == "sharding":
            assert Counter(ids) == Counter(seen)
            slots = after.groupBy("shard").agg({"slot": "max", "*": "count"}).collect()
            assert all(r["max(slot)"] + 1 == r["count(1)"] for r in slots)
        else:
            assert sorted(ids) == sorted(want) and after.columns == docs.columns
        docs, seen = after, ids
    rows = corpus_pipeline.run(spark, sf).select("doc_id", "size").collect()
    assert Counter(r.doc_id for r in rows) == Counter(seen)


def test_mixing_keeps_the_callers_columns(spark, sf):
    docs = queries.table(spark, sf, "documents").withColumn("domain", F.lit("mine")).withColumn("row", F.lit(1)).withColumn("epoch", F.lit(-1))
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mixed.columns == docs.columns
    assert {(r.domain, r.row, r.epoch) for r in mixed.select("domain", "row", "epoch").distinct().collect()} == {("mine", 1, -1)}
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), sf).count() == 0
