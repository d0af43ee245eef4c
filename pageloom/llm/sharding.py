"""Sharding by sampled splitters: shards of near equal bytes from a range partition.

Keys are hashes of texts, so equal texts lie together.  A sample in which a
record's chance is proportional to its size gives the quantiles that bound the
ranges; the sample grows with the number of ranges, not with the data.  Exact
sizes per range follow.  A range holding more than ``OVERFULL`` times its due,
such as one text held by a third of all rows, is subdivided by a hash of row
and id, so no task ever gets such a group whole.  Records are numbered within
their range, ranges are laid end to end, and a record's shard follows from the
bytes before it: each shard's bytes differ from the mean by less than one record.

A record's size is the UTF-8 length of its text (null: 0) plus 16.  Null ids,
empty texts, ties and repeated rows are records like any other.  The result
follows law ``bytes``; ``grown_shard`` is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.sources import scratch

SHARDS = 40
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 2_000_000
SAMPLES_PER_RANGE = 16
OVERFULL = 2.0
OVERHEAD = 16


def _rank(bounds: list[int], key: Column) -> Column:
    """Number of bounds that are at most ``key``, by binary search over literals."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < bounds[mid], search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(bounds))


def _tree_rank(splitters: list[int], key: Column) -> Column:
    """Range of a key: the two upper levels by comparison, the rest by counting."""
    if len(splitters) <= 64:
        return _rank(splitters, key)
    step = -(-len(splitters) // 64)
    heads = splitters[::step][1:]
    groups = [splitters[k : k + step] for k in range(0, len(splitters), step)]
    table = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
    group = _rank(heads, key)
    return (group * step + F.size(F.filter(F.element_at(table, group + 1), lambda b: b <= key))).cast("int")


def _splitters(sample: list[int], ranges: int) -> list[int]:
    """Distinct quantile boundaries of sampled keys."""
    keys = sorted(sample)
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def assign(docs: DataFrame, shards: int = SHARDS, carry: tuple[str, ...] = (), ranges_per_shard: int = RANGES_PER_SHARD) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row, and the carried columns in ``row``.

    Carried columns move with the records; without them only ids, sizes and hashes do.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    record = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("row_no"),
        *([F.struct(*carry).alias("row")] if carry else []),
    )
    # Row numbers hold only within one run of a plan, so they are stored before use.
    record = scratch.materialise(record, "records")
    total, rows = record.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(shards * ranges_per_shard, rows // ROWS_PER_RANGE)
    spread = F.xxhash64("doc_id", "row_no")
    chance = F.col("size") * (ranges * SAMPLES_PER_RANGE / max(total, 1))
    drawn = record.filter((F.pmod(F.xxhash64(F.lit(6), "row_no"), F.lit(1 << 30)) / float(1 << 30)) < chance)
    splitters = _splitters([r.key for r in drawn.select("key").collect()], ranges)

    ranged = record.withColumn("range", _tree_rank(splitters, F.col("key")))
    due = total / ranges
    full = {r["range"]: r["bytes"] for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > OVERFULL * due).collect()}
    parts = F.lit(1)
    if full:
        parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for r, b in full.items() for x in (r, -(-b // max(int(due), 1)))]), F.col("range")), F.lit(1))
    ranged = ranged.withColumn("part", F.pmod(spread, parts.cast("long")))
    w = Window.partitionBy("range", "part").orderBy("key", "doc_id", "row_no")
    numbered = ranged.withColumn("before", F.sum("size").over(w) - F.col("size")).withColumn("index", F.row_number().over(w).cast("long") - 1)
    numbered = scratch.materialise(numbered.drop("key", "row_no"), "numbered")
    sizes = numbered.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    order = Window.orderBy("range", "part")
    starts = sizes.select("range", "part", (F.sum("bytes").over(order) - F.col("bytes")).alias("from_byte"), (F.sum("n").over(order) - F.col("n")).alias("from_row"))
    placed = numbered.join(F.broadcast(starts), ["range", "part"]).select(
        "*", F.least(F.lit(shards - 1), F.floor((F.col("from_byte") + F.col("before")) * F.lit(float(shards)) / F.lit(float(max(total, 1))))).cast("int").alias("shard"),
        (F.col("from_row") + F.col("index")).alias("position"),
    )
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["row"] if carry else []),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write every shard as one folder of Parquet, rows in slot order; returns the assignment as written."""
    placed = assign(docs, shards, tuple(docs.columns))
    out = placed.select("shard", "slot", "size", F.col("row").alias("document"))
    out.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
