"""Removal of repeated byte strings by a suffix sort over sampled splitters.

Every text is its UTF-8 bytes.  A byte goes if a string of ``LENGTH`` bytes that
covers it also starts earlier: in a row of smaller ``doc_id``, or at a smaller
place under the same id.  Strings are judged on the input and never cross rows.

One suffix per byte would be some sixty times the input, so suffixes are thinned
without losing any string.  In every string of ``LENGTH`` bytes the run of
``SEED`` bytes with the least hash is its anchor; equal strings have equal
anchors at equal offsets.  Neighbouring strings share anchors, which leaves one
suffix in some forty bytes.  It carries the run of strings anchored there.

1. Anchors whose seed occurs once in the corpus go: a filter of bounded size,
   which lets every repeated seed through.
2. Runs with the same bytes around their anchors are folded into the first one;
   all strings of the others start earlier.  What is left meets other runs only
   in part: the borders of repeated passages.
3. Their suffixes, with the bytes before them, are range-partitioned by their
   leading bytes with sampled splitters.  A bucket sorts its suffixes, and the
   reversed bytes before them, by multikey quicksort.  Strings at one offset are
   equal where they share a run of the first order as long as their right part
   and a run of the second as long as their left part; all but the first go.
4. Suffixes with one seed lie in one bucket, unless there are more of them than
   a bucket holds.  Such a group is split by the bytes that follow, by those
   before, and by id, so that a passage found in a third of all rows spreads over
   as many buckets as it needs.  Strings of its first or last run in a bucket may
   continue in the next one: the first of each is compared across boundaries by
   its digest.

A null text is empty; null ids come first; rows of the same id and text lose
the same bytes.  Texts shorter than ``LENGTH`` stay whole.  An empty table gives
no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm import summaries
from pageloom.llm import words as W
from pageloom.sources import scratch

LENGTH = 100
SEED = 24
SPAN = LENGTH - SEED + 1  # seeds within one string
SEGMENT = 1 << 20  # strings looked at in one go
BUCKET_ROWS = 100_000
RIGHT, LEFT = 104, 80  # bytes after and before an anchor, padded to words of eight
FIRST_ID = -(2**63)

ANCHORS = "seed long, region long, id long, key long, place long"
SUFFIXES = "id long, key long, place long, hot boolean, right binary, before binary"
#: ``digest`` is null for a removed span, else the first of equal strings, to be compared across buckets.
MARKS = "id long, key long, start long, end long, digest binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_U = np.uint64
_PLACE_BITS = 21
_PLACE = _U((1 << _PLACE_BITS) - 1)


class Anchors:
    """Anchors of a batch: ``at``, and the first and last string (``low``, ``high``) anchored there."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw = raw
        lows, highs, ats = [], [], []
        for start in range(0, max(len(raw) - LENGTH + 1, 0), SEGMENT):
            part = raw[start : start + SEGMENT + LENGTH - 1]
            place = np.arange(len(part) - SEED + 1)
            least = (W.range_hash(part, place, place + SEED) & ~_PLACE) | place.astype(np.uint64)
            width = 1
            while 2 * width <= SPAN:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < SPAN:
                least = np.minimum(least[: width - SPAN], least[SPAN - width :])
            at = start + (least & _PLACE).astype(np.int64)
            begin = np.arange(start, start + len(at))
            inside = begin + LENGTH <= offsets[np.searchsorted(offsets, begin, "right").clip(max=len(offsets) - 1)]
            at, begin = at[inside], begin[inside]
            if len(at):
                change = np.flatnonzero((at[1:] != at[:-1]) | (begin[1:] != begin[:-1] + 1)) + 1
                lows.append(begin[np.append(0, change)])
                highs.append(begin[np.append(change - 1, len(begin) - 1)])
                ats.append(at[np.append(0, change)])
        empty = [np.empty(0, np.int64)]
        self.low, self.high, self.at = np.concatenate(lows or empty), np.concatenate(highs or empty), np.concatenate(ats or empty)
        self.text = np.searchsorted(offsets, self.low, "right") - 1
        # mixed again, as the least hashes of many are not spread over all values
        self.seed = W.mix(W.range_hash(raw, self.at, self.at + SEED) + _U(SEED))

    def region(self, keep: np.ndarray) -> np.ndarray:
        """Hash of all bytes of the strings at each kept anchor."""
        return W.mix(W.range_hash(self.raw, self.low[keep], self.high[keep] + LENGTH) + _U(LENGTH))


def _pack_place(low: np.ndarray, at: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the first string, with the anchor's offsets from the first and the last one."""
    return (low << 16) | ((at - low) << 8) | (at - high)


def _unpack_place(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, (place >> 8) & 255, place & 255


def _seeds(docs: DataFrame, parts: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting, size = [], 0
            for part in W.chunks(batch):
                waiting.append(summaries.codes(Anchors(*W.text_bytes(part.column("text"))).seed, parts))
                size += len(waiting[-1])
                if size > 1 << 20:
                    yield summaries.pack(np.concatenate(waiting))
                    waiting, size = [], 0
            if size:
                yield summaries.pack(np.concatenate(waiting))

    return docs.select("text").mapInArrow(pack, summaries.PACKED)


def _repeated(docs: DataFrame, repeated) -> DataFrame:
    """Anchors whose seed may occur elsewhere."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                raw, offsets = W.text_bytes(part.column("text"))
                found = Anchors(raw, offsets)
                keep = np.flatnonzero(repeated.value.keeps(found.seed))
                text, base = found.text[keep], offsets[found.text[keep]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(found.seed[keep].view(np.int64)), pa.array(found.region(keep).view(np.int64)),
                    part.column("id").take(pa.array(text)), part.column("key").take(pa.array(text)),
                    pa.array(_pack_place(found.low[keep] - base, found.at[keep] - base, found.high[keep] - base)),
                ], ["seed", "region", "id", "key", "place"])

    return docs.mapInArrow(anchors, ANCHORS)


def _rows_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be wanted, so that a join moves few other texts."""
    return docs.filter(summaries.may_hold(docs.sparkSession.sparkContext.broadcast(summaries.members(wanted.select("key"))), "key"))


def _suffixes(docs: DataFrame, borders: DataFrame) -> DataFrame:
    """The bytes before and after every border's anchor; ``hot`` where its seed has more of them than a bucket holds."""
    wanted = scratch.materialise(borders.groupBy("key").agg(F.collect_set(F.struct("place", "hot")).alias("places")), "borders")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                ids, keys, places, hot, right, before = [], [], [], [], [], []
                for id_, key, text, own in zip(*(part.column(c) for c in ("id", "key", "text", "places")), strict=True):
                    raw = text.as_py().encode()
                    for place, many in (tuple(x.values()) for x in own.as_py()):
                        low, up, down = place >> 16, (place >> 8) & 255, place & 255
                        right.append(raw[low + up : low + up - down + LENGTH])
                        before.append(raw[low : low + up][::-1])
                        ids.append(id_)
                        keys.append(key)
                        places.append(place)
                        hot.append(many)
                yield pa.RecordBatch.from_arrays([
                    pa.array([x.as_py() for x in ids], pa.int64()), pa.array([x.as_py() for x in keys], pa.int64()), pa.array(places, pa.int64()), pa.array(hot, pa.bool_()),
                    pa.array(right, pa.binary()), pa.array(before, pa.binary()),
                ], ["id", "key", "place", "hot", "right", "before"])

    return _rows_of(docs, wanted).join(wanted.hint("merge"), "key").select("id", "key", "text", "places").mapInArrow(cut, SUFFIXES)


def matrix(values: pa.Array, width: int) -> np.ndarray:
    """Byte strings as rows of ``width`` bytes, padded with zeros."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(values.buffers()[2] or b"\0", np.uint8)
    size = np.diff(offsets)
    out = np.zeros((len(values), width), np.uint8)
    row = np.repeat(np.arange(len(values)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = raw[offsets[0] : offsets[-1]]
    return out


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows: by eight bytes at a time, going deeper only where rows are still equal."""
    keys = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.arange(len(keys))
    active, group = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    for depth in range(keys.shape[1]):
        if not len(active):
            break
        own = keys[order[active], depth]
        sub = np.lexsort((own, group))
        order[active] = order[active[sub]]
        own, group = own[sub], group[sub]
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (group[1:] != group[:-1])
        group = np.cumsum(fresh)
        tied = np.bincount(group)[group] > 1
        active, group = active[tied], group[tied]
    return order


def common_prefix(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes each row of the order shares with the one before it; the first shares none."""
    out = np.zeros(len(order), np.int64)
    for start in range(1, len(order), 1 << 16):
        own = order[start : start + (1 << 16)]
        differ = rows[own] != rows[order[start - 1 : start - 1 + len(own)]]
        out[start : start + len(own)] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def _runs(order: np.ndarray, shared: np.ndarray, length: int) -> np.ndarray:
    """Number of the run of rows equal over ``length`` bytes, by row."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(shared < length) - (1 if len(order) and shared[0] < length else 0)
    return out


def compare(bucket: pa.Table) -> pa.Table:
    """Removed spans of one bucket's strings, and the first strings that may recur in other buckets."""
    ids, keys, places = (bucket.column(c).to_numpy() for c in ("id", "key", "place"))
    right, before = (matrix(bucket.column(c).combine_chunks(), w) for c, w in (("right", RIGHT), ("before", LEFT)))
    low, up, down = _unpack_place(places)
    right_order, left_order = multikey_order(right), multikey_order(before)
    right_shared, left_shared = common_prefix(right, right_order), common_prefix(before, left_order)
    hot = bucket.column("hot").to_numpy()
    n = len(ids)
    marked = np.zeros((n, SPAN + 1), bool)
    open_rows, open_offsets = [], []
    for offset in range(int(down.min()), int(up.max()) + 1):
        valid = np.flatnonzero((down <= offset) & (offset <= up))
        suffix = _runs(right_order, right_shared, LENGTH - offset)
        group = suffix * n + _runs(left_order, left_shared, offset)
        begin = low[valid] + up[valid] - offset
        sort = np.lexsort((begin, ids[valid], group[valid]))
        own = valid[sort]
        fresh = np.ones(len(own), bool)
        fresh[1:] = group[own[1:]] != group[own[:-1]]
        lead = own[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]  # the first string of the group
        later = (ids[own] != ids[lead]) | (low[own] + up[own] != low[lead] + up[lead])
        marked[own[later], offset] = True
        outer = (suffix[own] == 0) | (suffix[own] == suffix[right_order[-1]])
        first = own[~later & outer & hot[own]]
        open_rows.append(first)
        open_offsets.append(np.full(len(first), offset))
    # a run of marked offsets of one anchor is one span
    edge = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, nearest = np.nonzero(edge == 1)
    farthest = np.nonzero(edge == -1)[1] - 1
    anchor = low + up
    spans = [ids[row], keys[row], anchor[row] - farthest, anchor[row] - nearest + LENGTH]
    row, offset = np.concatenate(open_rows), np.concatenate(open_offsets)
    digests = [hashlib.blake2b(before[r, :o][::-1].tobytes() + right[r, : LENGTH - o].tobytes(), digest_size=16).digest() for r, o in zip(row, offset, strict=True)]
    begin = anchor[row] - offset
    out = [np.concatenate([a, b]) for a, b in zip(spans, [ids[row], keys[row], begin, begin + LENGTH], strict=True)]
    return pa.Table.from_arrays([*(pa.array(x, pa.int64()) for x in out), pa.array([None] * len(spans[0]) + digests, pa.binary())], ["id", "key", "start", "end", "digest"])


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition is one bucket; it is of bounded size by its splitters."""
    rows = [b for b in batches if b.num_rows]
    if rows:
        yield from compare(pa.Table.from_batches(rows)).to_batches()


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(FIRST_ID)).alias("id"), F.xxhash64(doc, text).alias("key"), text.alias("text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(key, start, end)`` of removed bytes; spans may overlap.  ``docs`` comes from ``_keyed``."""
    spark = docs.sparkSession
    long = docs.filter(F.octet_length("text") >= LENGTH)
    mass = long.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = summaries.parts_for(mass // (SPAN // 2))
    repeated = spark.sparkContext.broadcast(summaries.frequent(_seeds(long, parts), parts, 2))
    anchors = scratch.materialise(_repeated(long.select("id", "key", "text"), repeated), "anchors")

    at = F.struct("id", "place")
    firsts = scratch.materialise(anchors.groupBy("seed", "region").agg(F.min(F.struct("id", "place", "key")).alias("first"), F.count("*").alias("n")), "regions")
    several = firsts.filter("n > 1").select("seed", "region", F.struct("first.id", "first.place").alias("lead"))
    copies = anchors.join(several, ["seed", "region"]).filter(at > F.col("lead"))
    low, down = F.shiftright("place", 16), F.col("place").bitwiseAND(255)
    up = F.shiftright("place", 8).bitwiseAND(255)
    folded = copies.select("key", low.alias("start"), (low + up - down + LENGTH).alias("end"))

    shared = firsts.groupBy("seed").agg(F.count("*").alias("regions")).filter("regions > 1")
    borders = firsts.join(shared, "seed").select("first.*", (F.col("regions") > BUCKET_ROWS).alias("hot"))
    suffixes = scratch.materialise(_suffixes(long.select("id", "key", "text"), borders), "suffixes")
    buckets = max(1, -(-suffixes.count() // BUCKET_ROWS))
    within = [F.when(F.col("hot"), F.col(c)) for c in ("right", "before", "id", "key", "place")]
    dealt = suffixes.repartitionByRange(buckets, F.substring("right", 1, SEED), *within)
    marks = scratch.materialise(dealt.mapInArrow(_bucketed, MARKS), "marks")

    begin = F.struct("id", "start")
    across = marks.filter("digest is not null")
    lead = across.groupBy("digest").agg(F.min(begin).alias("lead"), F.count("*").alias("n")).filter("n > 1")
    later = across.join(lead, "digest").filter(begin > F.col("lead"))
    return folded.unionByName(marks.filter("digest is null").select("key", "start", "end")).unionByName(later.select("key", "start", "end"))


def merge_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Union of spans as disjoint, non-adjacent ones in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for part in W.chunks(batch):
            for doc_id, text, spans in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                raw, gone = text.encode(), merge_spans(spans)
                edges = [0, *(x for span in gone for x in span), len(raw)]
                kept = hashlib.sha256()
                for start, end in zip(edges[::2], edges[1::2], strict=True):
                    kept.update(raw[start:end])
                rows.append((doc_id, len(raw), sum(e - s for s, e in gone), len(gone), kept.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 4 + [pa.string()])],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def with_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, spans)`` of the rows that lose bytes; spans are byte ranges and may overlap."""
    docs = _keyed(docs)
    spans = repeated_spans(docs).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return docs.join(spans.hint("merge"), "key").select("doc_id", "text", "spans")


def dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    docs = _keyed(docs)
    spans = scratch.materialise(repeated_spans(docs).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")
    touched = summaries.may_hold(docs.sparkSession.sparkContext.broadcast(summaries.members(spans.select("key"))), "key")
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    some = docs.filter(touched).join(spans.hint("merge"), "key", "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    whole = docs.filter(~touched).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return some.mapInArrow(_cut, RESULT).unionByName(whole)
