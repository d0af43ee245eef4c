import random
from urllib.parse import urljoin, urlparse

from conftest import rows
from pyspark.sql import functions as F

from pageloom.functions import urls as u
from pageloom.functions.fixed import MEDIA_EXTENSIONS, PROHIBITED_SEGMENTS
from pageloom.operators import domains as dm

BASE = "https://x.com/a/b?q=1"
GOLDEN = {
    "": "https://x.com/a/b?q=1",
    "#f": "https://x.com/a/b?q=1",
    "?z=2": "https://x.com/a/b?q=1",
    "../c?p=1": "https://x.com/c",
    "/A/B/": "https://x.com/a/b",
    "HTTPS://X.com/Q?B=2&a=1&b=9&page=3&c=&a=0#t": "https://x.com/q?b=9&a=0&a=1",
    "https://www.example.com/page?name=John&age=30&page=1#section-1": "https://www.example.com/page?name=John&age=30",
    "/a.JPG": None,
    "/b.jpg/": "https://x.com/b.jpg",
    "/img/x": None,
    "/imgs/x": "https://x.com/imgs/x",
    "mailto:me@y.z": "https://x.com/a/me@y.z",
    "javascript:void(0)": "https://x.com/a/void(0)",
    "/a;P=1": "https://x.com/a",
    "https://y.z/a;P=1": "https://y.z/a;P=1",
    "https://y.z/?a=%zz&b=x+y%20z&c=~*": "https://y.z/?a=%25zz&b=x+y+z&c=~%2A",
    "/É/ü": "https://x.com/é/ü",
    "http://[::1/x": None,
    "https://y.z/?Page=1": "https://y.z",
}


def test_golden_normal_forms_in_both_forms(spark):
    df = spark.createDataFrame([(k, BASE) for k in GOLDEN], "href string, page_url string")
    made = u.with_normalized_url(df).collect()
    as_column = df.withColumn("url", u.normalize_url(F.col("href"), F.col("page_url"))).collect()
    assert {r.href: r.url for r in made} == GOLDEN
    assert {r.href: r.url for r in as_column} == GOLDEN


def test_filtered_links_are_left_out(spark):
    df = spark.createDataFrame([(k, BASE) for k in GOLDEN], "href string, page_url string")
    kept = u.with_normalized_url(df, drop_filtered=True)
    assert sorted(r.url for r in kept.collect()) == sorted(v for v in GOLDEN.values() if v)


def test_options(spark):
    df = spark.createDataFrame([("C?z=1&Y=2&page=4", BASE), ("mailto:a@b", BASE)], "h string, b string")
    n = lambda **o: [r[0] for r in df.select(u.normalize_url(F.col("h"), F.col("b"), **o)).collect()]
    assert n(compat=False) == ["https://x.com/a/c?z=1&y=2", None]
    assert n(compat=False, sort_keys=True, keep_path_case=True, drop_params=()) == ["https://x.com/a/C?page=4&y=2&z=1", None]


def test_every_fixed_filter_value(spark):
    df = spark.createDataFrame([(f"/x{e.upper()}",) for e in MEDIA_EXTENSIONS] + [(f"/a/{w}/b",) for w in PROHIBITED_SEGMENTS], "p string")
    assert df.filter(~u.is_media_path(F.col("p")) & ~u.is_prohibited_path(F.col("p"))).count() == 0
    ok = spark.createDataFrame([("/jpg",), ("/a/images",), ("/x.jpg/y",)], "p string")
    assert ok.filter(~u.is_media_path(F.col("p")) & ~u.is_prohibited_path(F.col("p"))).count() == 3


def _random_urls(n, seed):
    rng = random.Random(seed)
    pieces = ["a", "B", "/", "/", "//", "..", ".", "?", "#", "&", "=", "a=1", "%41", "é", "+", ";", ":", "http:", "https://", "X.com", "mailto:", "~", "@"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))) for _ in range(n)]


def test_parts_and_resolution_agree_with_the_standard_library(spark):
    bases = ["https://x.com/a/b?q=1", "https://x.com", "http://x.com/a/;p?B#f", "https://x.com/a/../b/c"]
    pairs = [(bases[i % 4], ref) for i, ref in enumerate(_random_urls(3000, 3))]
    df = spark.createDataFrame(pairs, "base string, ref string")
    for r in u.with_resolved_url(df, "ref", "base", "joined").collect():
        assert r.joined == urljoin(r.base, r.ref), (r.base, r.ref)
    for r in u.with_url_parts(df, "ref").collect():
        assert (r.scheme, r.netloc, r.path, r.params, r.query, r.fragment) == tuple(urlparse(r.ref)), r.ref


def test_normal_forms_are_stable(spark):
    df = spark.createDataFrame([(r, BASE) for r in _random_urls(2000, 5)], "href string, page_url string")
    once = u.with_normalized_url(df, drop_filtered=True).select(F.col("url").alias("href"), "page_url").filter("href rlike '^https?://[a-z][^;?]*$'")
    twice = u.with_normalized_url(once)
    changed = twice.filter("url is null or url <> href").select("href", "url").collect()
    assert changed == []


def test_image_addresses(spark):
    page = "https://x.com/a/b"
    want = {
        "/i.png": "https://x.com/i.png", "//cdn.y/z.png": "https://cdn.y/z.png", "img/q.png": "https://x.com/a/img/q.png",
        "data:image/png;base64,AA": "data:image/png;base64,AA", "http://o/p": "http://o/p", "../u.png?x=1#y": "https://x.com/u.png?x=1#y",
    }
    df = spark.createDataFrame([(s, page) for s in want], "src string, page_url string")
    assert {r.src: r.image_url for r in u.with_image_url(df).collect()} == want
    assert {r.src: r.i for r in df.select("src", u.resolve_image(F.col("src"), F.col("page_url")).alias("i")).collect()} == want


def test_main_domains(spark):
    want = {
        "https://mail.google.com/mail/u/0/": "google.com", "https://www.speedtest.net/apps/windows": "speedtest.net",
        "http://forums.bbc.co.uk/": "bbc.co.uk", "ftp://ftp.debian.org/debian/": "debian.org",
        "http://intranet:8080/x": "intranet", "http://user@a.b.com:99/": "b.com", "http://10.0.0.1/": "10.0.0.1",
        "http://co.uk/": ".co.uk",
    }
    df = spark.createDataFrame([(x,) for x in want], "url string")
    suffixes = spark.createDataFrame([(s,) for s in ["com", "net", "org", "uk", "co.uk"]], "suffix string")
    for listed in (suffixes, [r.suffix for r in suffixes.collect()]):
        assert {r.url: r.main_domain for r in dm.with_main_domain(df, "url", listed).collect()} == want
    rules = ["ck", "*.ck", "!www.ck"]
    hosts = spark.createDataFrame([("http://a.b.c.ck/",), ("http://x.www.ck/",)], "url string")
    many = spark.createDataFrame([(s,) for s in rules], "suffix string").unionAll(spark.range(25_000).selectExpr("concat('x', id, '.zz') AS suffix"))
    for listed in (rules, many):
        assert rows(dm.with_main_domain(hosts, "url", listed).select("main_domain")) == [("b.c.ck",), ("www.ck",)]


def test_internal_and_external_links(spark):
    df = spark.createDataFrame(
        [("x.com", "https://x.com/a"), ("x.com", "https://notx.com/b"), ("x.com", "/c"), ("x.com", "https://y.com/x.com")],
        "main_domain string, href string")
    assert rows(dm.filter_internal(df).select("href")) == [("https://notx.com/b",), ("https://x.com/a",)]
    assert rows(dm.exclude_external(df, "href", suffixes=["com"]).select("href")) == [("https://x.com/a",)]
    assert rows(dm.exclude_social(df, ["y.com"], "href", ["com"]).select("href")) == [
        ("/c",), ("https://notx.com/b",), ("https://x.com/a",)]


def test_same_domain_agrees_with_comparing_every_domain(spark):
    pages = ["https://a.x.com/p", "https://y.co.uk", "http://lone/"]
    urls = ["https://x.com/1", "https://A.x.com/2", "https://b.x.com:8/3", "https://x.org/4", "http://www.y.co.uk/5", "http://lone/6", "/7"]
    df = spark.createDataFrame([(u_, p) for u_ in urls for p in pages], "url string, page_url string")
    rules = spark.createDataFrame([(s,) for s in ["com", "org", "uk", "co.uk"]], "suffix string")
    want = [(u_, p) for u_, p in [(urls[0], pages[0]), (urls[1], pages[0]), (urls[2], pages[0]), (urls[4], pages[1]), (urls[5], pages[2])]]
    assert rows(dm.keep_same_domain(df, "url", "page_url", rules).select("url", "page_url")) == sorted(want, key=repr)
    assert rows(dm.keep_same_domain(df, "url", "page_url", ["com", "org", "uk", "co.uk"]).select("url", "page_url")) == sorted(want, key=repr)
