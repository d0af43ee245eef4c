"""Ranked lexical search over a length-stratified index.

Documents with the same normaliser ``m = 10 + (90 * n * N) div L`` are one
stratum: a term's impact there depends on ``tf`` alone and is computed once per
``tf``.  A stratum is stored in blocks of bounded size, one row for each term of
a block: the distinct ``tf``, descending, and the documents of each.  The row
without a term holds the block's document ids by place.

A search visits strata in the order of their bounds, the sum over an item's
terms of the impact of the greatest ``tf`` there.  The first visit takes each
item's best strata until they hold ``FIRST_VISIT`` documents; the score of the
last wanted rank among them is a threshold, and a later visit only takes strata,
and in each only the items, whose bound reaches it.  Ties are kept, so the
result is that of scoring everything.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII, only A-Z lower-cased.  Null and empty texts have none and are not ranked.
Equal scores rank by ``doc_id``, null ids last; rows that share an id are
documents of their own, rows of equal id and score in any order.  Items with the
same id are one item with the terms of all.  Empty tables give no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.sources import scratch

TOP = 10
BLOCK_POSTINGS = 1 << 18
FIRST_VISIT = 4096  # documents of the strata an item visits first
BATCH_TERMS = 1 << 18  # terms of the items searched in one pass
LAST_ID = 2**63 - 1

FORWARD = "doc_id long, n long, terms array<string>, tfs array<int>"
INDEX = "m long, block long, term string, n int, tf array<int>, ends array<int>, places array<int>, ids array<long>"
HITS = "item int, doc_id long, score long"

_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall((text or "").encode().translate(_LOWER))


def impact(tf: int, m: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of every document that has any, with their counts."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            ids, sizes, terms, tfs, ends = [], [], [], [], [0]
            for doc_id, text in zip(part.column("doc_id"), part.column("text"), strict=True):
                found = terms_of(text.as_py())
                if found:
                    own: dict[bytes, int] = {}
                    for term in found:
                        own[term] = own.get(term, 0) + 1
                    ids.append(doc_id.as_py())
                    sizes.append(len(found))
                    terms.extend(own)
                    tfs.extend(own.values())
                    ends.append(len(terms))
            lists = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(lists, pa.array(terms, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(lists, pa.array(tfs, pa.int32())),
            ], ["doc_id", "n", "terms", "tfs"])


def _invert(block: pa.Table) -> pa.Table:
    """Postings of one block: for each term the documents by descending ``tf``."""
    block = block.combine_chunks()
    m, number = block.column("m")[0].as_py(), block.column("block")[0].as_py()
    ids = block.column("doc_id").combine_chunks()
    order = np.argsort(ids.fill_null(LAST_ID).to_numpy(), kind="stable")  # places follow ids, so ties do as well
    place_of = np.empty(len(order), np.int32)
    place_of[order] = np.arange(len(order))
    lists = block.column("terms").combine_chunks()
    codes = lists.flatten().dictionary_encode()
    term, tf = codes.indices.to_numpy(), block.column("tfs").combine_chunks().flatten().to_numpy()
    place = np.repeat(place_of, lists.value_lengths().to_numpy())
    sort = np.lexsort((place, -tf, term))
    term, tf, place = term[sort], tf[sort], place[sort]
    fresh = np.ones(len(term), bool)
    fresh[1:] = term[1:] != term[:-1]
    run = fresh.copy()
    run[1:] |= tf[1:] != tf[:-1]
    first, runs = np.flatnonzero(fresh), np.flatnonzero(run)
    size = np.diff(np.append(first, len(term)))
    run_first = np.searchsorted(runs, first)
    run_ends = np.append(runs[1:], len(term)) - np.repeat(first, np.diff(np.append(run_first, len(runs))))
    k = len(first)
    offsets = pa.array(np.append(run_first, len(runs)), pa.int32())
    rows = pa.Table.from_arrays([
        pa.array(np.full(k, m)), pa.array(np.full(k, number)), codes.dictionary.take(pa.array(term[first])), pa.array(size, pa.int32()),
        pa.ListArray.from_arrays(offsets, pa.array(tf[runs], pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(run_ends, pa.int32())),
        pa.ListArray.from_arrays(pa.array(np.append(first, len(term)), pa.int32()), pa.array(place, pa.int32())), pa.nulls(k, pa.list_(pa.int64())),
    ], ["m", "block", "term", "n", "tf", "ends", "places", "ids"])
    empty = pa.array([None], pa.list_(pa.int32()))
    head = pa.Table.from_arrays([
        pa.array([m]), pa.array([number]), pa.array([None], pa.string()), pa.array([len(ids)], pa.int32()), empty, empty, empty,
        pa.array([ids.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
    ], rows.column_names)
    return pa.concat_tables([head, rows])


@dataclass(frozen=True)
class Index:
    """``rows`` by (stratum, block, term); ``N`` documents with a term, ``L`` terms in all."""

    rows: DataFrame
    strata: DataFrame
    N: int
    L: int


def build(docs: DataFrame) -> Index:
    """Index every row of ``docs`` that has a term."""
    forward = scratch.materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_forward, FORWARD), "terms")
    total = forward.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = total["N"], total["L"] or 1
    wide = "decimal(38,0)"
    product = (F.col("n").cast("decimal(19,0)") * F.lit(90 * n_docs).cast("decimal(18,0)")).cast(wide)
    forward = forward.withColumn("m", F.lit(10).cast("long") + F.call_function("div", product, F.lit(n_terms).cast(wide)))
    strata = forward.groupBy("m").agg(F.count("*").alias("docs"), F.sum(F.size("terms")).alias("postings"))
    strata = scratch.materialise(strata.withColumn("blocks", F.ceil(F.col("postings") / BLOCK_POSTINGS).cast("long")), "strata")
    deal = F.pmod(F.xxhash64("doc_id", "terms"), F.col("blocks"))
    rows = forward.join(strata.select("m", "blocks"), "m").withColumn("block", deal).select("m", "block", "doc_id", "terms", "tfs").groupBy("m", "block").applyInArrow(_invert, INDEX)
    return Index(scratch.materialise(rows, "index"), strata, n_docs, n_terms)


class Batch:
    """Terms and weights of some items; items and terms are numbered."""

    def __init__(self, items: list[tuple[int | None, set[str]]], frequency: dict[str, int], n_docs: int):
        self.ids = [item_id for item_id, _ in items]
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in frequency.items()}
        self.terms = [sorted(t for t in terms if self.weight.get(t, 0) > 0) for _, terms in items]

    def search(self, block: pa.Table, least: list[int], top: int) -> list[tuple[int, int | None, int]]:
        """Each item's ``top`` documents of one block that score ``least`` or more."""
        block = block.combine_chunks()
        m, term = block.column("m")[0].as_py(), block.column("term").combine_chunks()
        head = int(np.flatnonzero(term.is_null().to_numpy(zero_copy_only=False))[0])
        ids = block.column("ids")[head].as_py()
        block = block.filter(term.is_valid())
        terms = block.column("term").to_pylist()
        tfs, ends, places = (block.column(c).combine_chunks() for c in ("tf", "ends", "places"))
        runs = tfs.value_lengths().to_numpy()
        tf, inverse = np.unique(tfs.flatten().to_numpy(), return_inverse=True)
        impacts = np.array([impact(int(x), m) for x in tf], np.int64)  # once for each tf of the stratum
        gain = impacts[inverse] * np.repeat(np.array([self.weight[t] for t in terms], np.int64), runs)
        end = ends.flatten().to_numpy()
        first_run = np.cumsum(runs) - runs
        length = np.diff(end, prepend=0)
        length[first_run] = end[first_run]
        gains, places = np.repeat(gain, length), places.flatten().to_numpy().astype(np.int64)
        stop = np.cumsum(block.column("n").to_numpy())
        postings = {t: (places[a:b], gains[a:b], int(g)) for t, a, b, g in zip(terms, np.append(0, stop[:-1]), stop, gain[first_run], strict=True)} if terms else {}
        out, scores = [], np.zeros(len(ids), np.int64)
        for item, terms in enumerate(self.terms):
            here = [postings[t] for t in terms if t in postings]
            if not here or sum(bound for _, _, bound in here) < least[item]:
                continue
            scores[:] = 0
            for places, gains, _ in here:
                scores[places] += gains
            reach = np.flatnonzero(scores >= max(least[item], 1))
            if len(reach) > top:
                cut = np.partition(scores[reach], -top)[-top]
                better, equal = reach[scores[reach] > cut], reach[scores[reach] == cut]
                reach = np.concatenate([better, equal[: top - len(better)]])  # places follow ids
            out += [(item, ids[p], int(scores[p])) for p in reach]
        return out


def _bound(tf: Column, m: Column) -> Column:
    """Impact of ``tf`` in stratum ``m``."""
    return F.call_function("div", F.lit(10**9) * tf, F.lit(1000) * tf + F.lit(8) * m)


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_batch(index: Index, items: list[tuple[int | None, set[str]]], top: int) -> DataFrame:
    spark = index.rows.sparkSession
    # broadcast: a batch holds some BATCH_TERMS terms and those of one item more
    wanted = spark.createDataFrame([(t,) for t in sorted(set().union(*(t for _, t in items)))], "term string")
    rows = index.rows.join(F.broadcast(wanted), "term", "left_semi")
    peaks = scratch.materialise(rows.groupBy("term", "m").agg(F.sum("n").alias("df"), F.max(F.element_at("tf", 1)).alias("tf")), "peaks")
    # at most one row for each term of the batch
    frequency = {r["term"]: r["df"] for r in peaks.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    batch = Batch(items, frequency, index.N)
    shared = spark.sparkContext.broadcast(batch)
    uses = spark.createDataFrame([(k, t, batch.weight[t]) for k, terms in enumerate(batch.terms) for t in terms], "item int, term string, w long")
    bounds = peaks.join(F.broadcast(uses), "term").groupBy("item", "m").agg(F.sum(F.col("w") * _bound(F.col("tf").cast("long"), F.col("m"))).alias("bound"))
    bounds = scratch.materialise(bounds.join(index.strata.select("m", "docs"), "m"), "bounds")
    held = F.sum("docs").over(Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1))
    first = scratch.materialise(bounds.withColumn("held", F.coalesce(held, F.lit(0))).filter(F.col("held") < FIRST_VISIT).select("m").distinct(), "visit")

    def visit(strata: DataFrame, least: list[int]) -> DataFrame:
        def search(block: pa.Table) -> pa.Table:
            found = shared.value.search(block, least, top)
            return pa.Table.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])

        here = rows.select(*index.rows.columns).unionByName(index.rows.filter("term is null")).join(strata, "m", "left_semi")
        return here.groupBy("m", "block").applyInArrow(search, HITS)

    seen = scratch.materialise(_ranked(visit(first, [1] * len(items)), top), "first-hits")
    least = [1] * len(items)
    for r in seen.filter(F.col("rank") == top).select("item", "score").collect():  # one row for each item of the batch
        least[r["item"]] = r["score"]
    floor = spark.createDataFrame(list(enumerate(least)), "item int, least long")
    rest = bounds.join(F.broadcast(floor), "item").filter("bound >= least").select("m").distinct().join(first, "m", "left_anti")
    hits = seen.select("item", "doc_id", "score").unionByName(visit(rest, least))
    ids = spark.createDataFrame(list(enumerate(batch.ids)), "item int, item_id long")
    return _ranked(hits, top).join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _batches(items: DataFrame) -> Iterator[list[tuple[int | None, set[str]]]]:
    """Items with their terms, some ``BATCH_TERMS`` at a time, rows of one id together."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).orderBy("item_id")
    out: list[tuple[int | None, set[str]]] = []
    size = 0
    for item_id, text in rows.toLocalIterator():
        terms = {t.decode() for t in terms_of(text)}
        if out and out[-1][0] == item_id:
            out[-1][1].update(terms)
        else:
            if size > BATCH_TERMS:
                yield out
                out, size = [], 0
            out.append((item_id, terms))
        size += len(terms)
    if size:
        yield out


def search(index: Index, items: DataFrame, top: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)`` of each item's ``top`` best documents with a score above 0."""
    out = index.rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for batch in _batches(items):
        out = out.unionByName(_search_batch(index, batch, top))
    return out
