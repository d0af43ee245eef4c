"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by their number of five-word shingles, with upper
sizes that are powers of two.  A document is long where an item is short, so
plain MinHash of both would hardly ever agree.  Therefore each partition looks
at the document in windows twice as long as its largest item, half overlapping:
an item held in one piece lies in one window, and then at least about a fifth
of window and item is common.  A window is a candidate for an item when any one
of ``PERMUTATIONS`` minima agree, which misses such a window with a chance under
(1 - 0.19) ** 64, about one in a million; an item in two or three scattered
pieces is still found with a chance over 0.999.  Windows share their
blocks' minima: one pass over the document serves all partitions.

Each candidate is verified against the whole document by exact containment, the
share of the item's distinct shingles that the document holds.

The documents are read once, nothing is shuffled and no document leaves its
task.  Items come in blocks of bounded size, so what is sent to the executors
has a bound however long the benchmark is; each block is one pass.

Nulls and empty texts hold nothing.  Items of fewer than five words are no
evidence and are not searched; documents of fewer words contain no item.
Repeated items and repeated documents each give rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm import words as W

PERMUTATIONS = 64
CONTAINMENT = 0.8
BLOCK_BYTES = 4 << 20  # text of the items searched in one pass
FILTER_BITS = 16
PAIRS = "item_id long, doc_id long, n_shingles long, n_shared long, containment double"

_FACTORS = np.random.default_rng(8).integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class ItemIndex:
    """Minima of the items of one block, by size partition and permutation."""

    def __init__(self, items: list[tuple[int | None, str]]):
        texts = pa.array([text for _, text in items], pa.string())
        words = W.Words(texts)
        shingles, first = words.shingles()
        self.ids, self.sets = [], []
        for i in np.flatnonzero(words.counts >= W.SHINGLE):
            self.ids.append(items[i][0])
            self.sets.append(np.unique(shingles[first[i] : first[i + 1]]))
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.upper = np.array([1 << max(int(n) - 1, 0).bit_length() for n in sizes], np.int64)
        minima = np.array([[(s * a).min() for a in _FACTORS] for s in self.sets], np.uint64).reshape(-1, PERMUTATIONS)
        self.levels = []
        for upper in sorted(set(self.upper.tolist())):
            members = np.flatnonzero(self.upper == upper)
            tables = []
            for j in range(PERMUTATIONS):
                order = np.argsort(minima[members, j], kind="stable")
                known = np.zeros(1 << FILTER_BITS, bool)
                known[minima[members, j] & np.uint64((1 << FILTER_BITS) - 1)] = True
                tables.append((minima[members, j][order], members[order], np.packbits(known)))
            self.levels.append((upper, tables))


def _blocks(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``width`` values within each text, and the blocks per text as offsets."""
    number = -(-np.diff(first) // width)
    offsets = np.concatenate([[0], np.cumsum(number)])
    starts = np.repeat(first[:-1] - offsets[:-1] * width, number) + np.arange(offsets[-1]) * width
    return starts, offsets


def candidates(index: ItemIndex, shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct (text, item) pairs of which some window and item share a minimum."""
    if not len(shingles) or not index.levels:
        return np.empty((0, 2), np.int64)
    widths = [upper for upper, _ in index.levels]
    plan, at = [], first
    for k, width in enumerate(widths):
        starts, offsets = _blocks(at, width if k == 0 else width // widths[k - 1])
        text = np.repeat(np.arange(len(first) - 1), np.diff(offsets))
        plan.append((starts, text, text[1:] == text[:-1]))
        at = offsets
    low = np.uint64((1 << FILTER_BITS) - 1)
    found, values = [], np.empty_like(shingles)
    maps = [[np.unpackbits(t[2]).view(bool) for t in tables] for _, tables in index.levels]
    for j, factor in enumerate(_FACTORS):
        minima = np.multiply(shingles, factor, out=values)
        for (starts, text, joined), (_, tables), known in zip(plan, index.levels, maps, strict=True):
            minima = np.minimum.reduceat(minima, starts)
            window = minima.copy()
            np.minimum(minima[:-1], minima[1:], out=window[:-1], where=joined)
            hits = np.flatnonzero(known[j][(window & low).astype(np.int64)])
            values_j, members, _ = tables[j]
            left, right = np.searchsorted(values_j, window[hits], "left"), np.searchsorted(values_j, window[hits], "right")
            for n in range(1, int((right - left).max(initial=0)) + 1):
                some = right - left >= n
                found.append(np.stack([text[hits[some]], members[left[some] + n - 1]], 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)


def leaks(index: ItemIndex, texts: pa.Array, containment: float) -> list[tuple[int, int, int, int]]:
    """(text, item, shingles of the item, shingles shared) of every verified pair."""
    shingles, first = W.Words(texts).shingles()
    out, own_text, own = [], -1, np.empty(0, np.uint64)
    for text, item in candidates(index, shingles, first).tolist():
        if text != own_text:
            own_text, own = text, np.unique(shingles[first[text] : first[text + 1]])
        wanted = index.sets[item]
        at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        shared = int((own[at] == wanted).sum())
        if shared >= containment * len(wanted):
            out.append((text, item, len(wanted), shared))
    return out


def _indexes(benchmark: DataFrame) -> Iterator[ItemIndex]:
    """The items in blocks of about ``BLOCK_BYTES`` of text, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for k in range(n):
        block = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield ItemIndex([tuple(r) for r in block.collect()])


def find_leaks(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``(item_id, doc_id, n_shingles, n_shared, containment)`` of all items held in documents."""
    out = None
    for index in _indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in W.chunks(batch):
                    rows = leaks(index, part.column("text"), containment)
                    ids = part.column("doc_id").to_pylist() if rows else []
                    yield pa.RecordBatch.from_arrays([
                        pa.array([index.ids[i] for _, i, _, _ in rows], pa.int64()),
                        pa.array([ids[t] for t, _, _, _ in rows], pa.int64()),
                        pa.array([n for _, _, n, _ in rows], pa.int64()),
                        pa.array([s for _, _, _, s in rows], pa.int64()),
                        pa.array([s / n for _, _, n, s in rows], pa.float64()),
                    ], ["item_id", "doc_id", "n_shingles", "n_shared", "containment"])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(search, PAIRS)
        out = found if out is None else out.unionAll(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for index in _indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in W.chunks(batch):
                    clean = np.ones(part.num_rows, bool)
                    clean[[t for t, _, _, _ in leaks(shared.value, part.column("text"), containment)]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
