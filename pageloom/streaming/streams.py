"""Streaming forms.  They share their rules with the batch operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from pageloom.functions import fixed
from pageloom.operators.links import extract_links, normalized_links
from pageloom.operators.logs import BLOCK_WINDOWS, in_blocks, latest_reports, task_monitor


def stream_discover(pages: DataFrame, site: str = "site", watermark: str | None = None, event_time: str = "ts", **options) -> DataFrame:
    """New links of arriving pages, each address of a site once.

    ``pages`` is ``(site, page_id, url, html)``.  Without ``watermark`` every
    address is remembered for good; with it, duplicates are dropped only while
    they are at most that late, which bounds the state.
    """
    keep = [site, "page_id", "page_url"] + ([event_time] if watermark else [])
    links = normalized_links(extract_links(pages, keep), **options)
    if watermark is None:
        return links.select(site, "url").dropDuplicates([site, "url"])
    timed = links.select(site, "url", event_time).withWatermark(event_time, watermark)
    return timed.dropDuplicatesWithinWatermark([site, "url"])


#: Buckets of the table of discovered addresses.
DISCOVERED_BUCKETS = 64


def _discovered(spark: SparkSession, path: str, schema: StructType, buckets: int) -> str:
    """Name of the bucketed table over ``path``; the files outlive the name."""
    name = f"pageloom_discovered_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{f.name}`" for f in schema)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def discover_into(pages: DataFrame, path: str, checkpoint: str, site: str = "site", buckets: int = DISCOVERED_BUCKETS, **options) -> StreamingQuery:
    """Add each address of a site to the table at ``path`` once, however long the stream runs.

    What is known is that table, not the state of the stream: each micro-batch
    is anti-joined with it, bucket by bucket, and only new rows move.  A batch
    that is run again after a failure finds its rows in the table and adds
    nothing twice.  ``buckets`` must stay the same for one table.
    """
    links = normalized_links(extract_links(pages, [site, "page_id", "page_url"]), **options).select(site, "url")
    name = _discovered(pages.sparkSession, path, links.schema, buckets)

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        spark.catalog.refreshTable(name)
        fresh = batch.distinct().join(spark.table(name), [site, "url"], "left_anti")
        fresh.write.mode("append").format("parquet").bucketBy(buckets, site, "url").saveAsTable(name)

    return links.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start()


def stream_monitor(tasks: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The last report of every task so far; write it with :func:`run_monitor`."""
    return latest_reports(tasks, order)


def run_monitor(latest: DataFrame, path: str, checkpoint: str, top: int = fixed.VISIBLE_TASKS) -> None:
    """Totals and first tasks after each micro-batch, under ``totals/batch=<n>`` and ``top/batch=<n>``."""
    def put(batch: DataFrame, number: int) -> None:
        totals, first = task_monitor(batch, top)
        totals.write.mode("overwrite").parquet(f"{path}/totals/batch={number}")
        first.write.mode("overwrite").parquet(f"{path}/top/batch={number}")

    latest.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("complete").foreachBatch(put).start().awaitTermination()


def stream_rate_audit(log: DataFrame, watermark: str = "10 minutes", limit: int = fixed.RATE_LIMIT, seconds: int = fixed.RATE_SECONDS) -> DataFrame:
    """The windows of :func:`rate_audit`, each emitted once when its time block can get no more rows.

    State is the instants of the blocks still open, with their counts; rows
    later than the watermark are dropped.
    """
    width, span = BLOCK_WINDOWS * seconds * 1_000_000, seconds * 1_000_000

    def audit(key: tuple, arrived: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        block = int(key[0])
        at, n = (np.array(x, np.int64) for x in (state.get if state.exists else ([], [])))
        if state.hasTimedOut:
            state.remove()
            order = np.argsort(at)
            at, total = at[order], np.concatenate([[0], np.cumsum(n[order])])
            held = total[1:] - total[np.searchsorted(at, at - span, "right")]
            over = (held > limit) & (at // width == block)
            yield pd.DataFrame({"window_start": at[over] - span, "window_end": at[over], "n_requests": held[over]})
            return
        for rows in arrived:
            at, place = np.unique(np.concatenate([at, rows["at"].to_numpy()]), return_inverse=True)
            n = np.bincount(place, np.concatenate([n, np.ones(len(rows), np.int64)]), len(at)).astype(np.int64)
        state.update((at.tolist(), n.tolist()))
        end = (block + 1) * width // 1000
        state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"window_start": [], "window_end": [], "n_requests": []}, dtype="int64")

    out = "window_start long, window_end long, n_requests long"
    timed = in_blocks(log.filter("ts is not null").withWatermark("ts", watermark).select("ts"), seconds)
    found = timed.groupBy("block").applyInPandasWithState(audit, out, "at array<long>, n array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.timestamp_micros("window_start").alias("window_start"), F.timestamp_micros("window_end").alias("window_end"), "n_requests")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived into Parquet files and stop.

    Results that replace earlier ones (``update``, ``complete``) are written
    per batch under ``batch=<n>``.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", path).start()
    else:
        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        query = writer.outputMode(mode).foreachBatch(put).start()
    query.awaitTermination()
