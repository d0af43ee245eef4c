"""Download and task logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import fixed


def fetch_outcome(attempts: DataFrame, max_attempts: int = fixed.MAX_ATTEMPTS) -> DataFrame:
    """Final outcome of every request of ``attempts(req_id, url, attempt, status, error)``.

    200 saves; 429, timeouts and unknown errors are tried again; any other
    status and a refused connection end the request.  What is neither saved nor
    ended after ``max_attempts`` is exhausted.
    """
    status, error = F.col("status"), F.col("error")
    ending = (
        F.when(status == 200, F.lit("saved"))
        .when(status.isNotNull() & (status != 429), F.lit("stopped"))
        .when(status.isNull() & (error == "connect"), F.lit("stopped"))
    )
    tried = attempts.filter(F.col("attempt") < max_attempts).withColumn("__end", ending)
    # min() of the ending attempt alone keeps the aggregate in hash form
    code = F.when(F.col("__end").isNotNull(), F.col("attempt") * 2 + F.when(F.col("__end") == "saved", 0).otherwise(1))
    per_request = tried.groupBy("req_id", "url").agg(
        F.min(code).alias("__code"), (F.max("attempt") + 1).alias("__tried"))
    outcome = (
        F.when(F.col("__code").isNull(), F.lit("exhausted"))
        .when(F.col("__code") % 2 == 0, F.lit("saved"))
        .otherwise(F.lit("stopped"))
    )
    return per_request.select(
        "req_id", "url", outcome.alias("outcome"),
        F.coalesce(F.floor(F.col("__code") / 2).cast("int") + 1, F.col("__tried")).alias("n_attempts"))


#: Width of a time block of the rate audit, in windows.
BLOCK_WINDOWS = 10


def in_blocks(log: DataFrame, seconds: int) -> DataFrame:
    """Rows of ``log`` with ``at`` (microseconds) and ``block``; those of a block's last window are in the next block too.

    Every window then lies in one block, so blocks can be judged apart.
    """
    width = BLOCK_WINDOWS * seconds * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    own = F.floor(at / width).cast("long")
    next_too = at - own * width > width - seconds * 1_000_000
    return log.withColumn("at", at).withColumn("block", F.explode(F.when(next_too, F.array(own, own + 1)).otherwise(F.array(own))))


def rate_audit(log: DataFrame, limit: int = fixed.RATE_LIMIT, seconds: int = fixed.RATE_SECONDS) -> DataFrame:
    """Every window ``(window_start, window_end]`` that ends at a request and holds more than ``limit``.

    The windows are not those of a fixed raster: a breach in any ``seconds``
    shows up in the one that ends with its last request.  Requests are counted
    per instant first; a range frame then runs within each time block.  Rows
    without a time are left out.
    """
    span = seconds * 1_000_000
    instants = in_blocks(log.filter("ts is not null").groupBy("ts").agg(F.count("*").alias("n")), seconds)
    frame = Window.partitionBy("block").orderBy("at").rangeBetween(1 - span, 0)
    counted = instants.withColumn("n_requests", F.sum("n").over(frame))
    own = F.col("block") == F.floor(F.col("at") / (BLOCK_WINDOWS * span))
    return counted.filter(own & (F.col("n_requests") > limit)).select(
        (F.col("ts") - F.make_dt_interval(secs=F.lit(seconds))).alias("window_start"), F.col("ts").alias("window_end"), "n_requests")


def latest_reports(tasks: DataFrame, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The last report of every task: a task seen queued, running and completed is one row.

    ``order`` tells which of a task's reports is the last.
    """
    state = [c for c in tasks.columns if c != "task_id"]
    last = F.max_by(F.struct(*state), F.struct(*order))
    return tasks.groupBy("task_id").agg(last.alias("__last")).select("task_id", "__last.*")


def status_rollup(tasks: DataFrame) -> DataFrame:
    """One row: tasks in all, by state, and memory used."""
    status = F.col("status")
    return tasks.agg(
        F.count("*").alias("total"),
        F.count_if(status == "IN_PROGRESS").alias("active"),
        F.count_if(status == "COMPLETED").alias("completed"),
        F.count_if(status == "FAILED").alias("failed"),
        F.sum("memory_mb").alias("memory_mb"))


def monitor_topn(tasks: DataFrame, top: int = fixed.VISIBLE_TASKS) -> DataFrame:
    """The tasks shown first: running, then queued, then by end time."""
    status = F.col("status")
    return tasks.orderBy(
        status != "IN_PROGRESS", status != "QUEUED", F.col("end_time").asc_nulls_last(), "start_time", "task_id").limit(top)


def task_monitor(tasks: DataFrame, top: int = fixed.VISIBLE_TASKS) -> tuple[DataFrame, DataFrame]:
    """Status totals and the tasks shown first."""
    return status_rollup(tasks), monitor_topn(tasks, top)


def throttle_codes(log: DataFrame, by: str = "site") -> DataFrame:
    """Share of responses per site that ask to slow down."""
    throttled = F.col("status").isin(*fixed.THROTTLE_CODES)
    answered = log.filter("status is not null")
    return answered.groupBy(by).agg(
        F.count("*").alias("n_responses"), F.count_if(throttled).alias("n_throttled"),
        (F.count_if(throttled) / F.count("*")).alias("throttled_share"))
