"""Every query against its SQL on the smallest tables, and the driver contract."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from pageloom.operators import report as rp
from pageloom.plans import catalog
from pageloom.plans import composites as cp
from pageloom.plans import views as v
from pageloom.sources import sinks
from pageloom.sources import tables as tb

QUERIES, SQL = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.fixture(scope="module", autouse=True)
def shared_walks():
    """Queries over the same walk share it; each walk is still made by the code under test."""
    made, walk = {}, cp.walk

    def once(spark, sf, limits=None, depth=v.WALK_DEPTH):
        key = (sf, str(limits), depth)
        if key not in made:
            made[key] = walk(spark, sf, limits, depth)
        return made[key]

    cp.walk = once
    yield
    cp.walk = walk


def _plain(value):
    return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((repr([_plain(r[i]) for i in order]) for r in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert _sorted(got, df.columns) == _sorted(want.fetchall(), names)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_names_agree():
    assert set(SQL) == set(QUERIES)
    assert set(entry_module.queries()) >= set(QUERIES) and set(entry_module.oracle_sql()) >= set(SQL)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_report_comes_back_from_every_format(spark, sf, tmp_path, fmt):
    report = rp.join_pages_images(v.walked(spark, sf), v.walked_images(spark, sf))
    sinks.sink_report(report, str(tmp_path / fmt), fmt)
    cols = ["site", "depth", "sheet", "page_url", "image_url", "ts"]
    back = tb.read_report(spark, str(tmp_path / fmt), fmt).na.fill("", ["image_url"]).select(*cols)
    want = sinks.report_sheet(report).select(*cols)
    assert sorted(map(repr, (tuple(map(str, r)) for r in back.collect()))) == sorted(map(repr, (tuple(map(str, r)) for r in want.collect())))
