import random

from conftest import rows
from pyspark.sql import functions as F

from pageloom.operators import logs as lg
from pageloom.sources import tables as tb
from pageloom.streaming import streams as st


def test_outcomes(spark):
    data = {
        "first": [(200, None)], "late": [(429, None), (429, None), (200, None)], "gone": [(404, None), (200, None)],
        "slow": [(None, "timeout")] * 3, "down": [(None, "connect"), (200, None)], "odd": [(None, "reset"), (200, None)],
        "fourth": [(429, None)] * 3 + [(200, None)],
    }
    log = spark.createDataFrame([(k, "u", i, *a) for k, tries in data.items() for i, a in enumerate(tries)],
                                "req_id string, url string, attempt int, status int, error string")
    assert {r.req_id: (r.outcome, r.n_attempts) for r in lg.fetch_outcome(log).collect()} == {
        "first": ("saved", 1), "late": ("saved", 3), "gone": ("stopped", 1), "slow": ("exhausted", 3),
        "down": ("stopped", 1), "odd": ("saved", 2), "fourth": ("exhausted", 3)}


def breaches(times, limit, seconds=60):
    """Windows of ``times`` (microseconds) that end at a request and hold more than ``limit``."""
    span = seconds * 1_000_000
    return sorted((t - span, t, n) for t in set(times) if (n := sum(t - span < x <= t for x in times)) > limit)


def instants(spark, times):
    return spark.createDataFrame([(t,) for t in times], "at long").select(F.timestamp_micros("at").alias("ts"))


def micros(df):
    return rows(df.select(F.unix_micros("window_start"), F.unix_micros("window_end"), "n_requests"))


START = 1_700_000_000_000_000  # 200 s into a time block


def test_a_breach_between_round_starts_is_found(spark):
    times = [START + (5 + i % 5) * 1_000_000 for i in range(300)] + [START + (61 + i % 4) * 1_000_000 for i in range(301)]
    over = lg.rate_audit(instants(spark, times))
    assert micros(over) == [(START + 4_000_000, START + 64_000_000, 601)]
    assert lg.rate_audit(instants(spark, times), limit=601).isEmpty()


def test_rate_audit_equals_brute_force(spark):
    rng = random.Random(3)
    times = [START + rng.randrange(1500 * 1_000_000) for _ in range(300)] + [START + rng.randrange(1500) * 1_000_000 for _ in range(300)]
    times += [START + 400_000_000 + d for d in (-60_000_000, -59_999_999, -1, 0, 1, 59_999_999, 60_000_000)] * 3  # round a block's border
    got = micros(lg.rate_audit(instants(spark, times), limit=25))
    assert got == sorted(breaches(times, 25), key=repr) and got
    assert micros(lg.rate_audit(instants(spark, times).unionAll(spark.sql("select cast(null as timestamp)")), 12, 20)) == sorted(breaches(times, 12, 20), key=repr)
    assert lg.rate_audit(instants(spark, times).limit(0)).isEmpty()


def test_rate_stream_equals_batch_over_shuffled_arrivals(spark, tmp_path):
    rng = random.Random(4)
    times = [START + rng.randrange(1500 * 1_000_000) for _ in range(400)]
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for k in range(4):
        instants(spark, times[k::4]).coalesce(1).write.mode("append").parquet(src)
        st.run_available(st.stream_rate_audit(spark.readStream.schema("ts timestamp").parquet(src), "1 hour", 18), out, state)
    instants(spark, [START + 20_000_000_000]).write.mode("append").parquet(src)
    st.run_available(st.stream_rate_audit(spark.readStream.schema("ts timestamp").parquet(src), "1 hour", 18), out, state)
    got = spark.read.schema("window_start timestamp, window_end timestamp, n_requests long").parquet(out)
    assert micros(got) == micros(lg.rate_audit(instants(spark, times), 18)) and not got.isEmpty()


def test_a_task_counts_once_over_its_reports(spark, tmp_path):
    schema = "task_id string, status string, memory_mb double, start_time int, end_time int, ts int"
    arrivals = [[("a", "QUEUED", 1.0, 0, None, 1), ("b", "QUEUED", 1.0, 1, None, 1), ("c", "IN_PROGRESS", 4.0, 0, None, 2)],
                [("a", "COMPLETED", 2.0, 0, 9, 5), ("a", "IN_PROGRESS", 3.0, 0, None, 3), ("b", "IN_PROGRESS", 5.0, 1, None, 4)]]
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for batch in arrivals:
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        st.run_monitor(st.stream_monitor(spark.readStream.schema(schema).parquet(src)), out, state, 2)
    totals = spark.read.parquet(f"{out}/totals")
    assert rows(totals.filter("batch = 0").drop("batch")) == [(3, 1, 0, 0, 6.0)]
    newest = totals.agg(F.max("batch")).first()[0]
    assert rows(totals.filter(F.col("batch") == newest).drop("batch")) == [(3, 2, 1, 0, 11.0)]
    assert rows(spark.read.parquet(f"{out}/top").filter(F.col("batch") == newest).select("task_id", "status")) == [("b", "IN_PROGRESS"), ("c", "IN_PROGRESS")]


def test_discovered_table_keeps_addresses_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    html = ["<a href=/a><a href=/b>", "<a href=/b/><a href=/c><a href=/a>", "<a href=/a><a href=/c>"]
    for i, text in enumerate(html):
        spark.createDataFrame([(i, "https://s.test", text)], tb.PAGES).write.mode("append").parquet(src)
        arriving = spark.readStream.schema(tb.PAGES).parquet(src).withColumn("site", F.lit("s"))
        query = st.discover_into(arriving, out, state, buckets=4)
        query.awaitTermination()
        assert not query.lastProgress["stateOperators"]  # nothing is remembered beside the table
    # a lost checkpoint reads everything again and still adds nothing
    arriving = spark.readStream.schema(tb.PAGES).parquet(src).withColumn("site", F.lit("s"))
    st.discover_into(arriving, out, str(tmp_path / "other"), buckets=4).awaitTermination()
    assert [r.url for r in spark.read.parquet(out).orderBy("url").collect()] == ["https://s.test/a", "https://s.test/b", "https://s.test/c"]


def test_task_views(spark):
    tasks = [("a", "QUEUED", 3), ("b", "COMPLETED", 1), ("c", "IN_PROGRESS", None), ("d", "FAILED", 0), ("e", "QUEUED", None)]
    df = spark.createDataFrame([(n, s, 1.5, e) for n, s, e in tasks], "task_id string, status string, memory_mb double, end_time int")
    totals, top = lg.task_monitor(df.withColumn("start_time", F.lit(0)), 4)
    assert rows(totals) == [(5, 1, 1, 1, 7.5)]
    assert [r.task_id for r in top.collect()] == ["c", "a", "e", "d"]


def test_throttle_share(spark):
    df = spark.createDataFrame([("s", 200), ("s", 429), ("s", 503), ("s", None), ("t", 200)], "site string, status int")
    assert rows(lg.throttle_codes(df)) == [("s", 3, 2, 2 / 3), ("t", 1, 0, 0.0)]


def test_discovery_over_two_arrivals(spark, tmp_path):
    """What arrives later adds only addresses not seen before; in all it equals the batch."""
    from pageloom.operators.links import extract_links, normalized_links
    html = ["<a href=/a><a href=/b>", "<a href=/b/><a href=/c><a href=/x.png>"]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, text in enumerate(html):
        page = spark.createDataFrame([(i, "https://s.test", text)], tb.PAGES)
        page.write.mode("append").parquet(src)
        arriving = spark.readStream.schema(tb.PAGES).parquet(src).withColumn("site", F.lit("s"))
        st.run_available(st.stream_discover(arriving), out, str(tmp_path / "state"))
    got = rows(spark.read.schema("site string, url string").parquet(out))
    batch = normalized_links(extract_links(spark.read.schema(tb.PAGES).parquet(src))).select(F.lit("s"), "url").distinct()
    assert got == rows(batch) and len(got) == 3


def test_bounded_discovery_plan(spark, tmp_path):
    spark.createDataFrame([(1, "u", "")], tb.PAGES).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(tb.PAGES).parquet(str(tmp_path / "in")).withColumns(
        {"site": F.lit("s"), "ts": F.current_timestamp()})
    out = st.stream_discover(stream, watermark="1 hour")
    assert out.isStreaming and "WithinWatermark" in out._jdf.queryExecution().analyzed().toString()


def test_late_rows_are_dropped_by_the_rate_stream(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for start, n in ((1_700_000_000, 3), (1_700_100_000, 1), (1_700_000_000, 9), (1_700_200_000, 1)):
        instants(spark, [start * 1_000_000] * n).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts timestamp").parquet(src)
        st.run_available(st.stream_rate_audit(stream, limit=2), out, str(tmp_path / "state"))
    got = spark.read.schema("window_start timestamp, window_end timestamp, n_requests long").parquet(out)
    assert micros(got) == [(1_699_999_940_000_000, START, 3)]
