"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text gets a lookup table over its bins, and so do a few pairs
of features.  The tables are sums of shallow trees: boosting goes round the
features in turn, each step fitting a tree of few leaves on one feature's bins,
then likewise on the pairs that explain most of what is left.  A score is the
logistic of an intercept and one table entry per feature and pair, looked up for
a whole batch at once; no tree is walked.

The model is fitted by the driver on at most ``max_train`` labelled documents,
those with the least hash of their id (a documented bound); all documents are
scored where they lie, with no shuffle.

Labels are averaged per ``doc_id`` and rounded (a half counts as 1); rows with a
null id or null label are not learned from.  A null or empty text has zeros as
features and gets a score like any other.  Repeated documents get equal scores.
Without labels of both kinds the score is the smoothed share of ones for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm import features as X
from pageloom.llm import words as W

MAX_TRAIN = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, SMOOTH = 120, 40, 0.15, 3, 5.0


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    trained: bool = False

    def score(self, matrix: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(matrix), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, matrix[:, j], "right")]
        for i, j, cuts_i, cuts_j, table in self.pairs:
            total += table[np.searchsorted(cuts_i, matrix[:, i], "right"), np.searchsorted(cuts_j, matrix[:, j], "right")]
        return 1 / (1 + np.exp(-total))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and position of the best cut of a row of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + SMOOTH) + (g.sum() - gl) ** 2 / (h.sum() - hl + SMOOTH) - g.sum() ** 2 / (h.sum() + SMOOTH)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf value of each bin, of a tree with at most ``LEAVES`` leaves over ordered bins."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        gains = [_best_split(g[a:b], h[a:b]) for a, b in leaves]
        k = int(np.argmax([x[0] for x in gains]))
        if gains[k][0] <= 1e-9:
            break
        a, b = leaves[k]
        leaves[k : k + 1] = [(a, a + gains[k][1]), (a + gains[k][1], b)]
    out = np.empty(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SMOOTH)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree that cuts both axes once."""
    best, out = 0.0, np.zeros_like(g)
    gs, hs = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    rows, cols = g.shape
    for r in range(1, rows):
        for c in range(1, cols):
            cells = [(0, r, 0, c), (0, r, c, cols), (r, rows, 0, c), (r, rows, c, cols)]
            sums = [(s[b, d] - s[a, d] - s[b, e] + s[a, e]) for a, b, e, d in cells for s in (gs, hs)]
            gain = sum(x**2 / (y + SMOOTH) for x, y in zip(sums[::2], sums[1::2], strict=True))
            if gain > best:
                best = gain
                for (a, b, e, d), x, y in zip(cells, sums[::2], sums[1::2], strict=True):
                    out[a:b, e:d] = x / (y + SMOOTH)
    return best, out


def fit(matrix: np.ndarray, label: np.ndarray) -> Model:
    """The model of labelled rows of features."""
    ones = float(label.sum())
    base = (ones + 1) / (len(label) + 2)
    model = Model(float(np.log(base / (1 - base))))
    if not 0 < ones < len(label):
        return model
    model.trained = True
    total = np.full(len(label), model.intercept)
    model.cuts = [_cuts(matrix[:, j], BINS) for j in range(matrix.shape[1])]
    codes = [np.searchsorted(cuts, matrix[:, j], "right") for j, cuts in enumerate(model.cuts)]
    model.tables = [np.zeros(len(cuts) + 1) for cuts in model.cuts]
    for _ in range(ROUNDS):
        for code, table in zip(codes, model.tables, strict=True):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _tree(np.bincount(code, label - p, len(table)), np.bincount(code, p * (1 - p), len(table)))
            table += step
            total += step[code]
    coarse = [_cuts(matrix[:, j], PAIR_BINS) for j in range(matrix.shape[1])]
    grid = [np.searchsorted(cuts, matrix[:, j], "right") for j, cuts in enumerate(coarse)]

    def cells(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        at = grid[i] * shape[1] + grid[j]
        return (np.bincount(at, label - p, shape[0] * shape[1]).reshape(shape), np.bincount(at, p * (1 - p), shape[0] * shape[1]).reshape(shape))

    p = 1 / (1 + np.exp(-total))
    ranked = sorted(((_cross(*cells(i, j, p))[0], i, j) for i in range(len(grid)) for j in range(i)), reverse=True)
    model.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for gain, i, j in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, table in model.pairs:
            p = 1 / (1 + np.exp(-total))
            step = RATE * _cross(*cells(i, j, p))[1]
            table += step
            total += step[grid[i], grid[j]]
    return model


def _measured(docs: DataFrame, keep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                matrix = X.measure(part.column("text"))
                ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
                yield pa.RecordBatch.from_arrays([part.column(keep), pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))], [keep, "x"])

    return docs.select(keep, "text").mapInArrow(run, f"{keep} long, x array<double>")


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("q")).filter("doc_id is not null and q is not null")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("q") >= 0.5).cast("int").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = texts.select("doc_id").join(known, "doc_id", "left_semi").distinct()
    chosen = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # At most max_train ids and labels, so a broadcast has a bound.
    rows = _measured(texts.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi"), "doc_id").dropDuplicates(["doc_id"])
    found = rows.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").select("x", "label").collect()
    return fit(np.array([r.x for r in found], float).reshape(-1, len(X.NAMES)), np.array([r.label for r in found], float))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(X.measure(part.column("text"))))], ["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """Fit, then score every document."""
    return score(docs, train(docs, labels, max_train), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted good, with all their columns; without a trained model all stay."""
    model = train(docs, labels, max_train)
    if not model.trained:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch):
                yield part.filter(pa.array(shared.value.score(X.measure(part.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
