"""What the review of round 3 found."""

import json

from pyspark.sql import functions as F

from conftest import rows
from pageloom.llm import components as cc
from pageloom.llm import jaccard_join as jj
from pageloom.operators import dedup as dd
from pageloom.operators import frontier as fr
from pageloom.operators import sections as sc
from pageloom.operators.ranking import with_row_number
from pageloom.plans import catalog
from pageloom.sources.scratch import materialise


def test_sections_json_nests_all_links_of_a_domain(spark, sf):
    got = catalog.QUERIES["sections_json"](spark, sf).collect()
    links = catalog.QUERIES["section_report"](spark, sf).collect()
    want = {}
    for r in links:
        want.setdefault(r.domain, {}).setdefault(r.section, []).append(r.url)
    assert len(got) == len(want) and {r.part for r in got} == {0}
    assert {r.domain: json.loads(r.json) for r in got} == {d: {d: {s: sorted(urls) for s, urls in sections.items()}} for d, sections in want.items()}


def test_sections_without_a_name_are_nested_too(spark):
    links = spark.createDataFrame([(None, None, "a"), (None, "s", "b"), ("d", "null", "c"), ("d", None, None)], "domain string, section string, url string")
    assert rows(sc.sections_document(links)) == [("d", '{"d":{"null":["c"]}}'), (None, '{"null":{"null":["a"],"s":["b"]}}')]


def test_tables_that_grow_with_the_images_are_not_broadcast(spark):
    images = spark.range(50).select(
        F.col("id").alias("ord"), F.substring(F.md5(F.col("id").cast("string")), 1, 16).alias("phash"),
        F.lit("00ff00ff00ff00ff").alias("ahash"), F.col("id").alias("size_bytes"))
    groups = dd.leader_groups(images)
    # only the starts of the numbering's slices, at most one for each task, are small enough
    joins = [x for x in groups._jdf.queryExecution().executedPlan().toString().splitlines() if "HashJoin" in x]
    assert all("__slice" in x for x in joins)
    groups = materialise(groups)
    ranked = with_row_number(groups, ["group_no"], ["ord"], "rank")
    hashes = materialise(dd.hashed(images).withColumnRenamed("ord", "n"))
    near = dd._near(hashes, hashes, None, 5, ordered=True)
    for df in (near, dd.similar_pairs(groups, groups.filter("ord = leader_ord")), dd.with_action(groups), ranked):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_keys_are_one_constant_in_the_plan(spark):
    hashes = spark.range(3).select(F.col("id").alias("n"), F.col("id").alias("p"), F.col("id").alias("a"))
    plan = dd._near(hashes, hashes, None, 5, ordered=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode([") == 2 and "named_struct" not in plan


def test_tables_that_grow_with_the_pages_are_not_broadcast_by_the_snapshot(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://a.test/{i}") for i in range(4)], "page_id long, url string")
    links = spark.createDataFrame([(0, 0, "/1"), (1, 0, "/2"), (2, 0, "/9")], "page_id long, pos int, href string")
    plans = []

    def kept(df, keys, label="table"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label)

    monkeypatch.setattr(fr, "materialise_bucketed", kept)
    snapshot = fr.build_snapshot(pages, links)
    assert len(plans) == 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert snapshot.edges.count() == 3
    assert sorted((r.page_id, r.last_block) for r in snapshot.pages.collect()) == [(0, 0), (1, 0), (2, 0), (3, None)]


def test_texts_that_share_no_node_stay_where_they_are(spark):
    keyed = spark.range(3000).select(F.expr("if(id % 1000 = 7, null, id)").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("key"), F.lit("x").alias("text"))
    want = keyed.filter("doc_id % 50 = 0 or doc_id is null").select("key", F.col("doc_id").alias("first_id"))
    got = jj._likely(keyed, want)
    assert got.columns == keyed.columns
    wanted = {r.key for r in want.collect()}
    kept = [r.key for r in got.collect()]
    assert wanted <= set(kept) and len(kept) <= len(wanted) + 5
    assert jj._likely(keyed, want.limit(0)).count() == 0


def test_edges_are_computed_once_for_both_directions(spark, monkeypatch):
    plans = []

    def kept(df, label="step"):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return materialise(df, label)

    monkeypatch.setattr(cc.scratch, "materialise", kept)
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (8, 9)], "a long, b long")
    assert sorted(map(tuple, cc.components(edges).collect())) == [(3, 3), (4, 3), (5, 3), (8, 8), (9, 8)]
    assert [label for label, _ in plans][0] == "edges" and "Union" not in plans[0][1]


def test_the_search_broadcasts_only_its_bitmap_and_keeps_plans_short(spark, monkeypatch):
    words = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda w: F.concat(F.lit("w"), (F.floor(F.col("id") / 3) * 100 + w).cast("string")))
    last = F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit(" x"), F.col("id").cast("string")))
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.array_join(words, " "), last).alias("text"))
    plans = []

    def kept(write):
        def run(df, *args):
            plans.append((args[-1], df._jdf.queryExecution().executedPlan().toString()))
            return write(df, *args)
        return run

    for name in ("materialise", "materialise_bucketed"):
        monkeypatch.setattr(jj.scratch, name, kept(getattr(jj.scratch, name)))
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jj.join(docs).collect())
    assert got == [(i, i // 3 * 3, 2) for i in range(60)]
    assert {"second-pairs", "pivots", "stray", "wanted"} <= {label for label, _ in plans}
    assert all("Broadcast" not in plan for label, plan in plans if label != "sets")
    assert max(plan.count("Join") for label, plan in plans if label != "linked") <= 10
