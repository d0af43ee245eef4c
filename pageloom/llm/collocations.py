"""Phrase collocation mining with Misra-Gries summaries per hash partition.

Texts, with A-Z lower-cased, are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
pieces into words ``[^\\x20\\x09]+``.  A phrase is a run of 1 to ``LONGEST`` words
of one piece; all counts are per language.

1. Every task packs the hashes of its words per hash partition; mergeable
   Misra-Gries summaries, whose capacity exceeds mass divided by the threshold,
   find the words that may be frequent.
2. The same for longer runs, but only those of words that survived: a phrase is
   never more frequent than any of its words.
3. A second pass counts the surviving phrases exactly, by their text.

What is summarised are hashes, so memory is bounded; a phrase that reaches the
threshold can't be lost, and one that does not is dropped by the exact count.
All later steps are joins over the frequent phrases: every part of a frequent
phrase is frequent too, so both sides of each cut are at hand.

A null language is ``und``; a null or empty text has no words.  Rows count as
often as they occur, whatever their ids.  Equal scores are ordered by count,
then by the phrase's bytes.  An empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm import summaries
from pageloom.llm import words as W
from pageloom.sources import scratch

LONGEST = 5
THRESHOLD = 100
TOP = 2000
COVERED = 100  # per cent of a candidate's count that a longer one must reach to replace it
FLUSH_BYTES = 2 << 20
COUNTS = "lang string, phrase string, size int, f long"

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2


class Runs:
    """Words of a batch: byte ranges over the lower-cased text, language, and runs within pieces."""

    def __init__(self, batch: pa.RecordBatch):
        raw, offsets = W.text_bytes(batch.column("text"))
        self.raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
        kind = _KIND[self.raw]
        opens, shuts = kind == 0, kind == 0
        opens[1:] &= kind[:-1] != 0
        shuts[:-1] &= kind[1:] != 0
        edges = offsets[(offsets > 0) & (offsets < len(raw))]
        opens[edges] = kind[edges] == 0
        shuts[edges - 1] = kind[edges - 1] == 0
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
        breaks = (kind == 2).astype(np.int64)
        breaks[edges] += 1  # another text is another piece
        self.piece = np.cumsum(breaks)[self.start]
        langs = batch.column("lang").fill_null("und").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.text = np.repeat(np.arange(batch.num_rows), np.diff(np.searchsorted(self.start, offsets)))
        self.lang = langs.indices.to_numpy()[self.text] if len(self.start) else np.empty(0, np.int32)
        seed = W.mix(_names(self.langs))
        self.hash = W.mix(W.range_hash(self.raw, self.start, self.end) ^ seed[self.lang]) if len(self.start) else np.empty(0, np.uint64)

    def of(self, size: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of all runs of ``size`` words, each known, within one piece."""
        n = max(len(self.start) - size + 1, 0)
        whole = self.piece[:n] == self.piece[size - 1 :][:n]
        if known is not None:
            for k in range(size):
                whole &= known[k : k + n]
        at = np.flatnonzero(whole)
        out = np.zeros(len(at), np.uint64)
        for k in range(size):
            out = W.mix(out + self.hash[at + k] * _STEP + _U(size))
        return at, out

    def phrase(self, at: int, size: int) -> bytes:
        return b" ".join(self.raw[self.start[k] : self.end[k]].tobytes() for k in range(at, at + size))


def _names(langs: list[str]) -> np.ndarray:
    """A hash of each language name, blanks and all."""
    raw, offsets = W.text_bytes(pa.array(langs, pa.string()))
    return W.range_hash(raw, offsets[:-1], offsets[1:])


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[Runs]:
    for batch in batches:
        for part in W.chunks(batch, size=FLUSH_BYTES):
            yield Runs(part)


def _packed(docs: DataFrame, parts: int, words=None) -> DataFrame:
    """Packed codes of single words, or of the longer runs of words that ``words`` keeps."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _flushes(batches):
            if words is None:
                found = [runs.of(1)[1]]
            else:
                known = words.value.keeps(runs.of(1)[1])
                found = [runs.of(size, known)[1] for size in range(2, LONGEST + 1)]
            yield summaries.pack(summaries.codes(np.concatenate(found), parts))

    return docs.mapInArrow(pack, summaries.PACKED)


def _counted(docs: DataFrame, words, phrases) -> DataFrame:
    """Occurrences of every surviving phrase, and of all words of a language (size 0), per flush."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _flushes(batches):
            lang, phrase, sizes, number = [], [], [], []
            for code, n in zip(*np.unique(runs.lang, return_counts=True), strict=True):
                lang.append(runs.langs[code])
                phrase.append(b"")
                sizes.append(0)
                number.append(int(n))
            known = None
            for size in range(1, LONGEST + 1):
                at, hashes = runs.of(size, known)
                kept = (words if size == 1 else phrases).value.keeps(hashes)
                if size == 1:
                    known = kept
                own, first, n = np.unique(hashes[kept], return_index=True, return_counts=True)
                places = at[kept][first]
                lang += [runs.langs[c] for c in runs.lang[places]]
                phrase += [runs.phrase(int(p), size) for p in places]
                sizes += [size] * len(own)
                number += n.tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(lang, pa.string()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int32()), pa.array(number, pa.int64()),
            ], ["lang", "phrase", "size", "f"])

    return docs.mapInArrow(count, COUNTS)


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``(lang, phrase, size, f)`` of all runs of 1 to 5 words with ``f >= threshold``; size 0 holds the words of a language."""
    spark = docs.sparkSession
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    mass = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = spark.sparkContext.broadcast
    parts = summaries.parts_for(mass // 2)
    words = share(summaries.frequent(_packed(docs, parts), parts, threshold))
    parts = summaries.parts_for((LONGEST - 1) * mass // 2)
    phrases = share(summaries.frequent(_packed(docs, parts, words), parts, threshold))
    counts = _counted(docs, words, phrases).groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return scratch.materialise(counts.filter((F.col("size") == 0) | (F.col("f") >= threshold)), "phrases")


def _decimal(column: str) -> Column:
    return F.col(column).cast("decimal(18,0)")


def _words(number: Column) -> Column:
    """The first words of a phrase, or the last ones where ``number`` is negative."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), number)


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``(lang, phrase, size, a, l, r, n, score)``."""
    totals = phrases.filter("size = 0").select("lang", F.col("f").alias("n"))
    known = phrases.filter("size between 1 and 4").select("lang", "phrase", "f")
    cut = phrases.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumns({
        "head": _words(F.col("k")),
        "rest": _words(F.col("k") - F.col("size")),
    })
    cut = cut.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(totals, "lang")
    # decimals, as 1000 * a * n and l * r may pass 64 bits
    product = (_decimal("a") * _decimal("n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)")
    cut = cut.withColumn("score", F.call_function("div", product, (_decimal("l") * _decimal("r")).cast("decimal(38,0)")))
    best = cut.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
    return best.select("lang", "phrase", "size", "a", "low.l", "low.r", "n", "low.score")


def covered(phrases: DataFrame, percent: int = COVERED) -> DataFrame:
    """``(lang, phrase)`` of the candidates inside a longer one that is ``percent`` as frequent.

    A longer candidate contains one of each size between, at least as frequent
    as itself, so those longer by one word decide.
    """
    longer = phrases.filter("size >= 3").select("lang", "size", F.col("f").alias("outer"), F.explode(F.array(
        _words(F.col("size") - 1), _words(1 - F.col("size")))).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    inner = phrases.filter("size >= 2").join(most, ["lang", "phrase"])
    return inner.filter(F.lit(100).cast("decimal(3,0)") * _decimal("outer") >= F.lit(percent).cast("decimal(9,0)") * _decimal("f")).select("lang", "phrase")


def mine(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, percent: int = COVERED) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` collocations."""
    phrases = frequent_phrases(docs, threshold)
    kept = scored(phrases).join(covered(phrases, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc(F.col("phrase").cast("binary")))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
