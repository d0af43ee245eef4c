import pytest
from conftest import rows
from pyspark.sql import functions as F

from pageloom.functions import labels as lb
from pageloom.operators.links import extract_images, extract_links, extract_tags, split_tags

PAGE = """<!-- <a href="hidden"> --><script>var a = "<a href='hidden'>"</script><style><a href=hidden></style>
<A class="x>y" HREF = 'a&amp;b&#39;&#x41;' t>q</a><a>none</a><a data-href="z" href=bare/x?y=1>k</a><abbr href="no">
<a title="href=foo" href=" padded ">l</a><img alt="1>2" src="i.png"><IMG SRC=''><img data-src=x src=y.png /><a href="cut"""


def _pages(spark, html):
    return spark.createDataFrame([(1, "https://x.com/", html)], "page_id long, url string, html string")


def test_links_and_images(spark):
    p = _pages(spark, PAGE)
    assert [(r.pos, r.href) for r in extract_links(p).collect()] == [(0, "a&b'A"), (1, ""), (2, "bare/x?y=1"), (3, "padded")]
    assert [(r.pos, r.src) for r in extract_images(p).collect()] == [(0, "i.png"), (2, "y.png")]


def test_one_pass_gives_the_same_links_and_images(spark):
    p = _pages(spark, PAGE)
    links, images = split_tags(extract_tags(p))
    assert rows(links) == rows(extract_links(p)) and rows(images) == rows(extract_images(p))


@pytest.mark.parametrize("html", [
    "<a " + '"" ' * 200_000 + "href=x>", "<a href='x" * 50_000, "<!--" * 100_000, "<script>" * 50_000, "<a " + "x" * 500_000, "&#" * 100_000,
])
def test_hostile_pages_end_quickly(spark, html):
    assert extract_links(_pages(spark, html)).count() <= 1


def test_links_need_only_their_columns(spark, sf):
    from pageloom.plans.views import raw_links
    plan = raw_links(spark, sf).groupBy("page_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan


def test_labels(spark):
    one = spark.range(1)
    v = lambda c: one.select(c).first()[0]
    assert [v(lb.extract_depth(F.lit(s))) for s in ("Depth Level 10", "depth level x", "Summary", "a7b9")] == [10, 0, 0, 7]
    assert v(lb.size_label(F.lit(60255 / 1024))) == "58.84"
    assert v(lb.size_label(F.lit(22.625))) == "22.62"
    assert v(lb.dims_label(F.lit(770), F.lit(513))) == "770x513"
    assert v(lb.basename(F.lit("a/b/c.jpg"))) == "c.jpg"
    assert [v(lb.extension(F.lit(s))) for s in ("a/.jpg", "b.tar.JPG", "c", "d.e/f")] == ["", ".jpg", "", ""]
    assert v(lb.manifest_name(F.lit(7), F.lit(2))) == "7_d2"
    assert v(lb.unescape_entities(F.lit("&#233;&lt;&#0;&amp;lt;&#x1F600;&nope;"))) == "é<�&lt;😀&nope;"
    assert v(lb.unescape_entities(F.lit("&#38;lt; &#38;#x41; &#X41;"))) == "&lt; &#x41; A"
    assert v(lb.format_ts(F.expr("timestamp'2024-05-06 07:08:09.9'"))) == "2024-05-06 07:08:09"
