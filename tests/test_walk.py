import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pageloom.operators import frontier as fr
from pageloom.operators import manifest as mf
from pageloom.operators import report as rp
from pageloom.operators import sections as sc
from pageloom.operators.ranking import with_row_number
from pageloom.plans import views as v
from pageloom.sources import sinks
from pageloom.sources import tables as tb


def test_row_numbers_of_a_hot_group(spark):
    df = spark.range(0, 20_000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).alias("k"), F.hash("id").alias("o"), "id")
    from pyspark.sql import Window
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")).cast("long"))
    got = with_row_number(df, ["k"], ["o", "id"], "n")
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and got.count() == 20_000


def _walk_by_hand(seed, graph, depth, limits):
    """Level by level over dicts: what a walk should find."""
    seen, level, crawled = [], [seed], []
    for d in range(depth + 1):
        level = level[: limits[d]] if limits[d] else level
        nxt = []
        for page in level:
            if page in graph:
                crawled.append((d, page))
                for link in graph[page]:
                    if link not in seen:
                        seen.append(link)
                        nxt.append(link)
        level = nxt
    return crawled, seen


@pytest.mark.parametrize("limits", [[None] * 4, [None, 3, None, 2]])
def test_walk_equals_a_walk_by_hand(spark, limits):
    rng = random.Random(4)
    url = lambda i: f"https://s.test/p{i}"
    graph = {url(i): [url(rng.randrange(40)) for _ in range(rng.randrange(6))] for i in range(30)}
    names = list(graph)
    pages = spark.createDataFrame([(i, n, "") for i, n in enumerate(names)], "page_id long, url string, html string")
    links = spark.createDataFrame([(i, p, h) for i, n in enumerate(names) for p, h in enumerate(graph[n])], "page_id long, pos int, href string")
    seeds = spark.createDataFrame([(0, names[0]), (1, names[7]), (2, names[0])], "ord long, domain string")
    crawl = fr.crawl_frontier(seeds, pages, links, max_depth=3, limits=limits)
    got = fr.with_ord(crawl.crawled).orderBy("site", "depth", "ord").collect()
    for seed in (names[0], names[7]):
        crawled, seen = _walk_by_hand(seed, graph, 3, limits)
        assert [(r.depth, r.url) for r in got if r.site == seed] == crawled
        assert {r.url for r in crawl.discovered.filter(F.col("site") == seed).collect()} == set(seen)


def test_seed_comes_back_unless_marked(spark):
    html = '<a href="#top">t</a><a href="/a/">a</a><a href="https://s.test/a">again</a>'
    pages = spark.createDataFrame([(1, "https://s.test", html), (2, "https://s.test/a", html)], "page_id long, url string, html string")
    seeds = spark.createDataFrame([(0, "https://s.test")], "ord long, domain string")
    walk = lambda **o: rows(fr.crawl_frontier(seeds, pages, max_depth=2, **o).crawled.select("depth", "url"))
    assert walk() == [(0, "https://s.test"), (1, "https://s.test"), (1, "https://s.test/a")]
    assert walk(mark_seed=True) == [(0, "https://s.test"), (1, "https://s.test/a")]


def test_level_limits_are_checked(spark):
    assert fr.level_limits(["all", 2, "all"], 3) == [None, 2, None, None]
    assert fr.level_limits(fr.limits_table(spark, [5, 2], 2), 2) == [None, 2, None]
    with pytest.raises(ValueError):
        fr.level_limits([None, 0], 2)
    with pytest.raises(ValueError):
        fr.batch_number(spark.range(1), 0)


def test_limit_keeps_the_first_of_each_site(spark):
    level = spark.createDataFrame([(f"s{i % 2}", f"u{i}", [i]) for i in range(50)], "site string, url string, trail array<int>")
    assert rows(fr.limit_per_depth(level, 7).select("url")) == sorted((f"u{i}",) for i in range(14))


def test_conflicting_limits_are_an_error(spark):
    table = spark.createDataFrame([(1, 2), (1, 2), (2, 3)], "depth int, max_urls int")
    assert fr.level_limits(table, 2) == [None, 2, 3]
    with pytest.raises(ValueError):
        fr.level_limits(table.unionAll(spark.createDataFrame([(1, 5)], "depth int, max_urls int")), 2)


def test_walk_stays_on_its_site_by_default(spark):
    pages = spark.createDataFrame([
        (1, "https://s.test", '<a href="https://other.org/x">o</a><a href="/a">a</a><a href="https://www.social.org/me">s</a>'),
        (2, "https://other.org/x", ""), (3, "https://s.test/a", ""), (4, "https://www.social.org/me", "")], "page_id long, url string, html string")
    seeds = spark.createDataFrame([(1, "https://s.test")], "ord long, domain string")
    walked = lambda **o: {r.page_id for r in fr.crawl_frontier(seeds, pages, max_depth=1, **o).crawled.collect()}
    assert walked() == {1, 3}
    assert walked(same_site=False) == {1, 2, 3, 4}
    assert walked(same_site=False, social=["social.org"]) == {1, 2, 3}


def test_later_levels_read_buckets_without_exchange(spark):
    """Edges keep their buckets: only the walked pages move."""
    edges = spark.createDataFrame([(1, 0, 0, "u")], "page_id long, block int, pos int, link string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = fr.materialise_bucketed(edges, ["page_id", "block"], "edges")
        crawled = spark.createDataFrame([("s", 1, [0], 0)], "site string, page_id long, trail array<int>, last_block int")
        plan = fr.follow(crawled, table)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pages_with_many_links_span_blocks(spark, monkeypatch):
    monkeypatch.setattr(fr, "LINK_BLOCK", 3)
    html = "".join(f'<a href="/p{i}">' for i in range(10))
    pages = spark.createDataFrame([(1, "https://s.test", html)], "page_id long, url string, html string")
    seeds = spark.createDataFrame([(0, "https://s.test")], "ord long, domain string")
    crawl = fr.crawl_frontier(seeds, pages, max_depth=1)
    assert [r.url for r in fr.with_ord(crawl.discovered).orderBy("ord").collect()] == [f"https://s.test/p{i}" for i in range(10)]


def test_walk_and_images_read_html_once(spark, tmp_path):
    """A snapshot with images gives the same walk and images, and neither reads the pages' html again."""
    html = ['<a href="/b"><img src="/1.png"><img src=""><a href="/c">', '<IMG src="2.png"><!-- <img src="no"> -->', "", None]
    data = [(i, f"https://s.test{p}", h) for i, (p, h) in enumerate(zip(["", "/b", "/c", "/d"], html, strict=True))]
    spark.createDataFrame(data, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    seeds = spark.createDataFrame([(0, "https://s.test")], "ord long, domain string")
    snapshot = fr.build_snapshot(pages, images=True)
    crawl, plain = fr.crawl_frontier(seeds, snapshot, max_depth=1), fr.crawl_frontier(seeds, pages, max_depth=1)
    images = fr.harvest_images(crawl.crawled, snapshot)
    want = fr.harvest_images(plain.crawled, pages)
    assert rows(crawl.discovered.select("url", "depth")) == rows(plain.discovered.select("url", "depth"))
    assert rows(images.select("page_url", "image_url", "pos")) == rows(want.select("page_url", "image_url", "pos"))
    assert images.count() == 2
    plan = rp.join_pages_images(crawl.crawled, images)._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in plan and "html" in want._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        fr.harvest_images(crawl.crawled, fr.build_snapshot(pages))


def test_report_is_one_join(spark):
    crawled = _crawled(spark)
    images = crawled.selectExpr("site", "url as page_url", "'i' as image_url", "ts", "depth", "trail", "0 as pos").filter("page_url <> 'c'")
    report = rp.join_pages_images(crawled, images)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "LeftOuter" in plan
    assert rows(report.filter("image_url is null").select("page_url", "depth", F.col("ts").isNotNull())) == [("c", 1, True)]


def _crawled(spark):
    data = [("s", "a", 0, [0], 1), ("s", "a", 1, [0, 0], 1), ("s", "b", 1, [0, 1], 2), ("s", "c", 1, [0, 2], 3)]
    return spark.createDataFrame(data, "site string, url string, depth int, trail array<int>, page_id long").withColumn(
        "ts", F.expr("timestamp'2024-01-01 00:00:00'"))


def test_report_counts_and_manifest(spark):
    crawled = _crawled(spark)
    media = spark.createDataFrame([(1, 0, "http://i/1"), (2, 0, "http://i/2"), (2, 1, "http://i/2"), (2, 2, "http://i/3"), (3, 0, "")], "page_id long, pos int, src string")
    images = fr.harvest_images(crawled, spark.createDataFrame([], "page_id long, url string, html string"), media)
    assert rp.total_images(images).first().total_images == 5
    report = rp.join_pages_images(crawled, images)
    # page a is walked twice, so each visit shows both copies of its image
    assert rows(report.groupBy("depth", "page_url").agg(F.count("image_url"), F.count("*"))) == [
        (0, "a", 2, 2), (1, "a", 2, 2), (1, "b", 3, 3), (1, "c", 0, 1)]
    assert [tuple(r) for r in rp.depth_summary(crawled, images).select("label", "n_urls", "n_images").collect()] == [
        ("Depth 0", 1, 2), ("Depth 1", 3, 5), ("Total", 4, 7)]
    manifest = mf.download_manifest(report)
    assert [tuple(r) for r in manifest.orderBy("depth", "row_num").select("filename", "folder").collect()][2:] == [
        (f"{n}_d1.jpg", "Downloaded_Images/s/Depth Level 1") for n in (2, 3, 4, 5, 6)]


def test_manifest_numbers_skip_empty_rows(spark):
    data = [("Depth Level 10", i, a) for i, a in enumerate(["u", None, "v", "", "w"])] + [("depth level x", 0, "y"), ("Summary", 0, "z")]
    sheets = spark.createDataFrame([("s", *d) for d in data], "site string, sheet string, ord int, image_url string")
    got = mf.download_manifest(sheets, "D", ["ord"]).select("filename", "url", "folder")
    assert rows(got) == [("2_d0.jpg", "y", "D/s/depth level x"), ("2_d10.jpg", "u", "D/s/Depth Level 10"),
                         ("4_d10.jpg", "v", "D/s/Depth Level 10"), ("6_d10.jpg", "w", "D/s/Depth Level 10")]
    assert rows(mf.manifest_count(mf.download_manifest(sheets, "D", ["ord"]))) == [("s", 0, 1), ("s", 10, 3), ("s", None, 4), (None, None, 4)]


def test_sections(spark):
    hrefs = ["https://x.com/Lone/1", "https://x.com/", "https://x.com/Blog/B", "https://x.com/blog/a", "HTTPS://X.com/BLOG/b",
             "/blog/relative", "https://notx.com/q", "https://z.com/blog"]
    links = spark.createDataFrame([("https://x.com", i, h) for i, h in enumerate(hrefs)], "domain string, ord long, href string")
    got = sc.sections(links, ["com"])
    assert rows(got.select("section", "url")) == [
        ("blog", "https://x.com/Blog/B"), ("blog", "https://x.com/blog/a"),
        ("root", "https://notx.com/q"), ("root", "https://x.com/"), ("root", "https://x.com/Lone/1")]
    assert rows(sc.sections_document(got).select("json")) == [(
        '{"https://x.com":{"blog":["https://x.com/Blog/B","https://x.com/blog/a"],'
        '"root":["https://notx.com/q","https://x.com/","https://x.com/Lone/1"]}}',)]
    assert rows(sc.sections_json(got).filter("section = 'blog'").select("pos", "json")) == [
        (1, '{"domain":"https://x.com","section":"blog","pos":1,"url":"https://x.com/Blog/B"}'),
        (2, '{"domain":"https://x.com","section":"blog","pos":2,"url":"https://x.com/blog/a"}')]


def test_section_lines_are_ordered_and_indexed(spark, tmp_path):
    links = [(f"https://d{i % 3}.com", "s" if i % 2 else "root", f"https://d{i % 3}.com/{i:04}") for i in range(300)]
    sinks.sink_sections(spark.createDataFrame(links, "domain string, section string, url string"), str(tmp_path / "out"))
    files = sorted((tmp_path / "out" / "lines").glob("part-*"))
    lines = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert [(x["domain"], x["section"], x["url"]) for x in lines] == sorted(links)
    index = spark.read.parquet(str(tmp_path / "out" / "index"))
    assert rows(index.groupBy("domain").agg(F.sum("n_lines"))) == [(f"https://d{i}.com", 100) for i in range(3)]


def test_seed_selection(spark):
    seeds = spark.createDataFrame([(2, " b\t"), (1, "a"), (3, None), (4, "a")], "ord long, domain string")
    assert [r.domain for r in tb.select_seeds(seeds, "all").orderBy("pos").collect()] == ["a", "b", "a"]
    assert [r.domain for r in tb.select_seeds(seeds, "2, 1,2").collect()] == ["b", "a", "b"]
    for bad in ("4", "0", "x", "1;2"):
        with pytest.raises(ValueError):
            tb.select_seeds(seeds, bad)


def test_fixture_walk_has_the_known_depths(spark, sf):
    from pageloom.plans.composites import walk
    crawl = walk(spark, sf)
    n = {r.depth: r.n for r in crawl.crawled.groupBy("depth").agg(F.count("*").alias("n")).collect()}
    assert n[0] == 4 and n[1] == 16 and sum(n.values()) == v.site_pages(spark, sf).count() + 4


def test_scratch_tables_can_be_removed(tmp_path, spark):
    from pathlib import Path

    from pageloom.sources import scratch
    path = scratch.new_path(spark, "x")
    spark.range(3).write.parquet(path)
    # only the folder of this table: other tests still read theirs
    root = scratch._folder
    scratch._folder = lambda s: path
    try:
        scratch.clear(spark)
    finally:
        scratch._folder = root
    assert not Path(path.removeprefix("file:")).exists()
