"""Language-model scoring with a gated recurrent network.

**Counts.**  Words (A-Z lower-cased) and one end per document are the tokens.
Counts of all training documents are summed by Spark; they give ``base_score``
and the word part of the model.

**Model.**  The softmax over words is factored by class: p(w | before) = p(class
| before) * p(w | class).  The most frequent ``HEAD`` words are classes of their
own; all others fall into classes by frequency and by shape (capital, mark at the
end, byte beyond ASCII, length), unseen words into the lowest frequency.  A gated
recurrent network in numpy predicts the class; p(w | class) comes from the counts
with half a count added per word and for one unseen word, so it covers every text.

**Training.**  Truncated backpropagation through time over windows of ``WINDOW``
tokens, the state carried from window to window.  It learns from every training
document: each task runs one pass of stochastic descent over all of its blocks
from the shared parameters and the results are averaged by number of tokens,
``ROUNDS`` times (on 25 MB the held-out gain over the counts is 0.234 a token
after one round, 0.270 after two, 0.273 with two rounds of 32 streams).

**Scoring.**  Every document is run whole, its state carried across windows, many
documents side by side, longest first.

**Data flow.**  One pass turns blocks of documents into compact rows: lengths, the
place of each token in the block's own vocabulary, and that vocabulary as 64-bit
hashes with shapes and counts.  Texts are not read again.  Vocabularies, far
smaller than the tokens, go by word to be counted and come back by block.

A null or empty text is its end alone.  Null ids are not held out.  Repeated rows
are rows like others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm import words as W
from pageloom.sources import scratch

HEAD, HIDDEN, WINDOW = 63, 16, 16
FREQUENCIES, SHAPES = 4, 16
CLASSES = HEAD + FREQUENCIES * SHAPES
ROUNDS, RATE, CLIP, STREAMS = 1, 0.01, 1.0, 128
BLOCK_BYTES = 16 << 20
FAN = 32
SEED = 10

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
END = np.uint64(0xE0D0_E0D0_E0D0_E0D1)
PARTS = ["doc_id", "no_id", "held_out", "length", "local", "vocabulary", "shape", "train_count"]
BLOCKS = "block long, tokens long, " + ", ".join(f"{p} binary" for p in PARTS)


def _shapes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Capital at the start, mark at the end, a byte beyond ASCII, more than six bytes."""
    beyond = np.concatenate([[0], np.cumsum(raw >= 128)])
    last = raw[end - 1]
    mark = ((last >= 33) & (last <= 47)) | ((last >= 58) & (last <= 64))
    capital = (raw[start] >= 65) & (raw[start] <= 90)
    return capital * 8 + mark * 4 + (beyond[end] > beyond[start]) * 2 + (end - start > 6)


class _Block:
    """Collects documents up to a size and packs them into one row."""

    def __init__(self) -> None:
        self.bytes, self.parts = 0, []

    def add(self, part: pa.RecordBatch) -> None:
        words = W.Words(part.column("text"))
        raw = words.raw
        hashes = W.range_hash(_LOWER[raw], words.start, words.end)
        vocabulary, example, local = np.unique(hashes, return_index=True, return_inverse=True)
        shape = _shapes(raw, words.start[example], words.end[example])
        self.parts.append((part.column("doc_id"), part.column("held_out"), words.counts, local, vocabulary, shape))
        self.bytes += len(raw)

    def row(self, name: int) -> dict:
        vocabulary, index = np.unique(np.concatenate([p[4] for p in self.parts] + [np.array([END])]), return_index=True)
        shape = np.concatenate([p[5] for p in self.parts] + [np.array([0])])[index].astype(np.uint8)
        end = int(np.searchsorted(vocabulary, END))
        locals_, lengths, held, ids, none = [], [], [], [], []
        for doc_id, held_out, counts, local, own, _ in self.parts:
            place = np.searchsorted(vocabulary, own)[local] if len(own) else np.empty(0, np.int64)
            out = np.full(len(place) + len(counts), end, np.uint32)
            last = np.cumsum(counts + 1) - 1
            body = np.ones(len(out), bool)
            body[last] = False
            out[body] = place
            locals_.append(out)
            lengths.append(counts + 1)
            held.append(held_out.to_numpy(zero_copy_only=False))
            ids.append(doc_id.fill_null(0).to_numpy(zero_copy_only=False))
            none.append(doc_id.is_null().to_numpy(zero_copy_only=False))
        local, length, held_out = np.concatenate(locals_), np.concatenate(lengths).astype(np.int64), np.concatenate(held)
        # Frequent words get small places, which pack well.
        order = np.argsort(-np.bincount(local, minlength=len(vocabulary)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        local, vocabulary, shape = rank[local], vocabulary[order], shape[order]
        train = np.bincount(local[np.repeat(~held_out, length)], minlength=len(vocabulary)).astype(np.uint32)
        values = [np.concatenate(ids).astype(np.int64), np.concatenate(none), held_out, length, local, vocabulary, shape, train]
        return {"block": name, "tokens": len(local)} | {p: pack(v) if p == "local" else v.tobytes() for p, v in zip(PARTS, values, strict=True)}


def pack(values: np.ndarray) -> bytes:
    """32-bit numbers by planes of bytes, compressed."""
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _part(row, name: str) -> np.ndarray:
    kinds = {"doc_id": np.int64, "no_id": bool, "held_out": bool, "length": np.int64, "local": np.uint32, "vocabulary": np.uint64, "shape": np.uint8, "train_count": np.uint32}
    return unpack(row[name]) if name == "local" else np.frombuffer(row[name], kinds[name])


def blocks(docs: DataFrame) -> DataFrame:
    """The corpus as block rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, block = TaskContext.get().partitionId(), 0, _Block()
        schema = pa.schema([("block", pa.int64()), ("tokens", pa.int64()), *[(p, pa.binary()) for p in PARTS]])
        for batch in batches:
            for part in W.chunks(batch):
                block.add(part)
                if block.bytes >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist([block.row((task << 24) + number)], schema)
                    number, block = number + 1, _Block()
        if block.parts:
            yield pa.RecordBatch.from_pylist([block.row((task << 24) + number)], schema)

    doc_id = F.col("doc_id").cast("long")
    held = F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 1, F.lit(False))
    return docs.select(doc_id.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out")).mapInArrow(run, BLOCKS)


def _vocabularies(packed: DataFrame) -> DataFrame:
    """``(block, place, word, shape, n)`` of every block's vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word = _part(row, "vocabulary")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(word), row["block"], np.int64)), pa.array(np.arange(len(word), dtype=np.int32)), pa.array(word.view(np.int64)),
                    pa.array(_part(row, "shape").astype(np.int32)), pa.array(_part(row, "train_count").astype(np.int64)),
                ], ["block", "place", "word", "shape", "n"])

    return packed.select("block", "vocabulary", "shape", "train_count").mapInArrow(run, "block long, place int, word long, shape int, n long")


class Network:
    """Gated recurrent unit over class inputs with a softmax over classes."""

    def __init__(self, values: np.ndarray | None = None):
        shapes = {"embed": (CLASSES, 3 * HIDDEN), "hidden": (HIDDEN, 3 * HIDDEN), "bias": (3 * HIDDEN,), "out": (HIDDEN, CLASSES), "out_bias": (CLASSES,)}
        size = sum(math.prod(s) for s in shapes.values())
        if values is None:
            values = np.random.default_rng(SEED).normal(0, 0.1, size).astype(np.float32)
        self.values, at = values, 0
        for name, shape in shapes.items():
            setattr(self, name, values[at : at + math.prod(shape)].reshape(shape))
            at += math.prod(shape)

    def step(self, state: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, ...]:
        """Next state after reading classes ``before``, and what backpropagation needs."""
        h = HIDDEN
        x = self.embed[before] + self.bias
        gates = 1 / (1 + np.exp(-(x[:, : 2 * h] + state @ self.hidden[:, : 2 * h])))
        update, reset = gates[:, :h], gates[:, h:]
        inner = state @ self.hidden[:, 2 * h :]
        fresh = np.tanh(x[:, 2 * h :] + reset * inner)
        return update * state + (1 - update) * fresh, update, reset, inner, fresh

    def log_probability(self, states: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of the chance of each target class."""
        scores = states @ self.out + self.out_bias
        scores -= scores.max(1, keepdims=True)
        picked = scores[np.arange(len(target)), target]
        return picked - np.log(np.exp(scores).sum(1))

    def learn(self, classes: np.ndarray, first: int) -> None:
        """One pass of truncated backpropagation over parallel streams ``(time, stream)``."""
        h, streams = HIDDEN, classes.shape[1]
        state = np.zeros((streams, h), np.float32)
        previous = np.full(streams, first)
        mean, square, steps = np.zeros_like(self.values), np.zeros_like(self.values), 0
        one = np.float32(1)
        for at in range(0, len(classes), WINDOW):
            window = classes[at : at + WINDOW]
            inputs = np.vstack([previous[None], window[:-1]])
            n = window.size
            # What does not depend on the state is taken for the whole window at once.
            read = (self.embed[inputs.ravel()] + self.bias).reshape(len(window), streams, 3 * h)
            states = np.empty((len(window) + 1, streams, h), np.float32)
            states[0] = state
            gates, inner, fresh = np.empty((len(window), streams, 2 * h), np.float32), np.empty_like(states[1:]), np.empty_like(states[1:])
            for t, x in enumerate(read):
                from_state = states[t] @ self.hidden
                g, f = gates[t], fresh[t]
                np.add(x[:, : 2 * h], from_state[:, : 2 * h], out=g)
                np.exp(np.negative(g, out=g), out=g)
                g += one
                np.reciprocal(g, out=g)
                inner[t] = from_state[:, 2 * h :]
                np.tanh(x[:, 2 * h :] + g[:, h:] * inner[t], out=f)
                np.add(f, g[:, :h] * (states[t] - f), out=states[t + 1])
            state = states[-1]
            seen = states[1:].reshape(n, h)
            p = seen @ self.out + self.out_bias
            p -= p.max(1, keepdims=True)
            np.exp(p, out=p)
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), window.ravel()] -= 1
            p /= n
            grad = Network(np.zeros_like(self.values))
            grad.out[:] = seen.T @ p
            grad.out_bias[:] = p.sum(0)
            errors = (p @ self.out.T).reshape(len(window), streams, h)
            # d_x: by what the gates and the fresh state get; d_h: by what the old state gives them.
            d_x, d_h = np.empty((2, len(window), streams, 3 * h), np.float32)
            back, weights = np.zeros((streams, h), np.float32), np.ascontiguousarray(self.hidden.T)
            update, reset, slope = gates[:, :, :h], gates[:, :, h:], gates * (one - gates)
            to_fresh = (one - update) * (one - fresh * fresh)
            to_update, to_reset = (states[:-1] - fresh) * slope[:, :, :h], inner * slope[:, :, h:]
            for t in range(len(window) - 1, -1, -1):
                back = back + errors[t]
                d_fresh = np.multiply(back, to_fresh[t], out=d_x[t, :, 2 * h :])
                np.multiply(back, to_update[t], out=d_x[t, :, :h])
                np.multiply(d_fresh, to_reset[t], out=d_x[t, :, h : 2 * h])
                d_h[t, :, : 2 * h] = d_x[t, :, : 2 * h]
                np.multiply(d_fresh, reset[t], out=d_h[t, :, 2 * h :])
                back = back * update[t] + d_h[t] @ weights
            d_x = d_x.reshape(n, 3 * h)
            order = np.argsort(inputs.ravel(), kind="stable")
            read_classes, starts = np.unique(inputs.ravel()[order], return_index=True)
            grad.embed[read_classes] = np.add.reduceat(d_x[order], starts)
            grad.bias[:] = d_x.sum(0)
            grad.hidden[:] = states[:-1].reshape(n, h).T @ d_h.reshape(n, 3 * h)
            # Adam; the windows of a narrow rest weigh as their share of a full one.
            steps += 1
            g = grad.values * min(1.0, CLIP / max(float(np.sqrt((grad.values**2).sum())), 1e-9))
            mean += (g - mean) * 0.1
            square += (g * g - square) * 0.01
            rate = RATE * min(1.0, n / (WINDOW * STREAMS / 4))
            self.values -= (rate * (mean / (1 - 0.9**steps)) / (np.sqrt(square / (1 - 0.99**steps)) + 1e-8)).astype(np.float32)
            previous = window[-1]


class Lexicon:
    """What the counts say: tokens, distinct words, words of the head, and tokens and words of each class."""

    def __init__(self, tokens: int, distinct: int, head: int, mass: np.ndarray, members: np.ndarray):
        self.tokens, self.distinct, self.head, self.mass, self.members = tokens, distinct, head, mass, members


def base_log10(count: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    return np.log10(count + 0.5) - math.log10(tokens + 0.5 * (distinct + 1))


def _average(models: DataFrame) -> DataFrame:
    """Means of parameter vectors weighted by tokens, in small groups."""
    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        weight = pdf["tokens"].to_numpy(float)
        rows = np.stack([np.frombuffer(v, np.float32) for v in pdf["params"]])
        return pd.DataFrame({"part": [0], "tokens": [int(weight.sum())], "params": [(rows.T @ (weight / weight.sum())).astype(np.float32).tobytes()]})

    return models.groupBy("part").applyInPandas(mean, "part long, tokens long, params binary")


def _class(head: list[int]) -> Column:
    """Class of a word: its place among the most frequent ones, or its frequency and shape."""
    frequency = F.least(F.lit(FREQUENCIES - 1), F.floor(F.log2(F.greatest("n", F.lit(1))) / 3)).cast("int")
    other = F.lit(HEAD) + frequency * SHAPES + F.col("shape")
    if not head:
        return other
    at = F.element_at(F.create_map(*[F.lit(x) for i, word in enumerate(head) for x in (word, i)]), F.col("word"))
    return F.when(F.col("word").isin(head), at).otherwise(other)


def score(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row."""
    spark = docs.sparkSession
    packed = scratch.materialise(blocks(docs), "blocks")
    # A block has a word once, so a word has as many rows as there are blocks with it;
    # one exchange by word gives every row the word's count, and one row of each stands for it.
    same = Window.partitionBy("word")
    words = _vocabularies(packed).select(
        "block", "place", "word", F.sum("n").over(same).alias("n"), F.min("shape").over(same).alias("shape"), (F.row_number().over(same.orderBy("block")) == 1).alias("stands"))
    words = scratch.materialise(words, "words")
    counts = words.filter("stands and n > 0")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = [r.word for r in counts.orderBy(F.desc("n"), "word").limit(HEAD).select("word").collect()]
    kind = _class(head)
    mass, members = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # a row per class
        mass[r.kind], members[r.kind] = r.n, r.words
    lexicon = Lexicon(tokens, distinct, len(head), mass, members)
    end = int(END.astype(np.int64))
    end_class = head.index(end) if end in head else CLASSES - 1
    known = words.groupBy("block").agg(F.collect_list(F.struct("place", "n", kind.cast("short").alias("kind"))).alias("known"))
    joined = packed.select("block", "tokens", "doc_id", "no_id", "held_out", "length", "local").join(known, "block")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            flat = one.column("known").flatten()
            part = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("place", "n", "kind")}
            yield {c: one.column(c)[0].as_py() for c in one.schema.names if c != "known"} | {"known": part}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows(batch):
                place = row["known"]["place"]
                count, kind = np.zeros(len(place), np.int64), np.zeros(len(place), np.uint8)
                count[place], kind[place] = row["known"]["n"], row["known"]["kind"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]]) for c in ("block", "tokens")] + [pa.array([row[p]], pa.binary()) for p in ("doc_id", "no_id", "held_out", "length", "local")]
                    + [pa.array([count.tobytes()], pa.binary()), pa.array([kind.tobytes()], pa.binary())],
                    ["block", "tokens", "doc_id", "no_id", "held_out", "length", "local", "count", "kind"],
                )

    ready = "block long, tokens long, doc_id binary, no_id binary, held_out binary, length binary, local binary, count binary, kind binary"
    ready = scratch.materialise(joined.mapInArrow(encode, ready), "classed")

    shared = spark.sparkContext.broadcast(lexicon)
    net = Network()
    # The softmax starts from the classes' own frequencies.
    net.out_bias[:] = np.log((lexicon.mass + 0.5) / (lexicon.mass.sum() + 0.5 * CLASSES))
    params = net.values
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast(params)

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            net, tokens = Network(start.value.copy()), 0
            for batch in batches:
                for i in range(batch.num_rows):
                    classes = _train_classes({c: batch.column(c)[i].as_py() for c in batch.schema.names})
                    if not len(classes):
                        continue
                    streams = max(1, min(STREAMS, len(classes) // WINDOW))
                    # Equal streams side by side; what is left over is a stream of its own.
                    steps = len(classes) // streams
                    net.learn(classes[: steps * streams].reshape(streams, steps).T, end_class)
                    if len(classes) > steps * streams:
                        net.learn(classes[steps * streams :][:, None], end_class)
                    tokens += len(classes)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([net.values.tobytes()], pa.binary())], ["tokens", "params"])

        found = ready.select("held_out", "length", "local", "kind").mapInArrow(learn, "tokens long, params binary").withColumn("part", F.spark_partition_id().cast("long"))
        found = scratch.materialise(found, "models")
        n = found.count()
        while n > FAN:
            found = scratch.materialise(_average(found.withColumn("part", F.floor(F.col("part") / FAN))).withColumn("part", F.spark_partition_id().cast("long")), "models")
            m = found.count()
            if m >= n:
                break
            n = m
        models = found.select("tokens", "params").collect()  # FAN vectors of fixed size at most
        if models:
            weight = np.array([r.tokens for r in models], float)
            params = (np.stack([np.frombuffer(r.params, np.float32) for r in models]).T @ (weight / weight.sum())).astype(np.float32)

    final = spark.sparkContext.broadcast(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, lex = Network(final.value), shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                yield _score_block(row, net, lex, end_class)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return ready.mapInArrow(run, schema)


def _train_classes(row: dict) -> np.ndarray:
    """Classes of all tokens of a block's training documents, in order."""
    kind = np.frombuffer(row["kind"], np.uint8)
    return kind[_part(row, "local")[np.repeat(~_part(row, "held_out"), _part(row, "length"))]].astype(np.int64)


def _score_block(row: dict, net: Network, lex: Lexicon, end_class: int) -> pa.RecordBatch:
    length, local, held_out, ids, none = (_part(row, p) for p in ("length", "local", "held_out", "doc_id", "no_id"))
    count, kind = np.frombuffer(row["count"], np.int64), np.frombuffer(row["kind"], np.uint8).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(length)])
    base = W.per_text(np.add, base_log10(count, lex.tokens, lex.distinct)[local], first, 0)
    n_known = W.per_text(np.add, (count > 0).astype(np.int64)[local], first, 0)
    # One unseen word stands in each class beside the seen ones; head classes hold their word alone.
    spread = lex.mass[kind] + 0.5 * (lex.members[kind] + 1)
    word_part = np.where(kind < lex.head, 0.0, np.log10(count + 0.5) - np.log10(np.maximum(spread, 1)))
    total = W.per_text(np.add, word_part[local], first, 0)

    order = np.argsort(-length, kind="stable")
    sizes = length[order]
    state = np.zeros((len(order), HIDDEN), np.float32)
    previous = np.full(len(order), end_class)
    at = first[:-1][order]
    active = len(order)
    t = 0
    chance = np.zeros(len(order))
    longest = int(sizes[0]) if len(sizes) else 0
    while t < longest:
        # A window: states are carried, the softmax of all its steps is taken at once.
        states, targets, owners = [], [], []
        for _ in range(WINDOW):
            while active and sizes[active - 1] <= t:
                active -= 1
            if not active:
                break
            state[:active] = net.step(state[:active], previous[:active])[0]
            now = kind[local[at[:active] + t]]
            states.append(state[:active].copy())
            targets.append(now)
            owners.append(active)
            previous[:active] = now
            t += 1
        if not states:
            break
        logs = net.log_probability(np.concatenate(states), np.concatenate(targets))
        done = 0
        for n in owners:
            chance[:n] += logs[done : done + n]
            done += n
    total[order] += chance / math.log(10)
    n = len(length)
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64(), mask=none), pa.array(held_out), pa.array(length), pa.array(n_known), pa.array(np.full(n, lex.tokens, np.int64)), pa.array(base.astype(float)), pa.array(total.astype(float)),
    ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
