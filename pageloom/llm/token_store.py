"""Token ids in binary shard files with a minimal perfect hash index.

Documents are range-partitioned by id, encoded where they land and written one
file per partition, in order.  A file holds, little-endian:

    ids of all its documents one after another, 2 bytes each (4 where the vocabulary needs it)
    end of each row in ids (u64), its doc_id (i64), whether that is null (u8)
    index: bits of all levels (packed), per slot a fingerprint (u32), first row (u32) and number of rows (u32)
    trailer: JSON with the counts and places of these parts, its length (u32), magic

The index is a minimal perfect hash: at each level keys that fall alone into
a bit set it, the others go on to the next level, and a key's slot is the number
of bits set before its own.  A look-up computes a few hashes, compares the stored
fingerprint and reads the ids at the offset: constant time whatever the size of
the file.  Rows with the same id lie together under one slot.

Files go through the file system of their URI (local, or any that pyarrow
reaches) to the shared folder.  Every attempt of a task writes a file of its own
name and the names that count come back as the rows of a Spark table, so a
repeated or lost attempt does no harm.

A null text is empty; each document ends with ``end_id``.  Rows with a null id
come first; they are read in order but have no key.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm import encoder as enc
from pageloom.llm import words as W
from pageloom.sources import scratch

END_ID = 2
SHARD_BYTES = 32 << 20
CHUNK = 4 << 20
MAGIC = b"PLTOKEN1"
LEVELS, SPACE = 40, 1.5
READ_IDS = 4 << 20
SHARDS = "shard int, file string, rows long, tokens long, lo long, hi long"

_SEEDS = np.random.default_rng(9).integers(1, 2**63, LEVELS, dtype=np.uint64)
_FINGER = np.uint64(0xA5A5_5A5A_1234_4321)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (W.mix(keys ^ _FINGER) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots ``0 .. n - 1`` of n distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.cumsum(bits) for bits in levels]
        self.before = np.concatenate([[0], np.cumsum([int(r[-1]) for r in self.ranks])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        for seed in _SEEDS:
            if not len(keys):
                break
            place = (W.mix(keys ^ seed) % np.uint64(int(SPACE * len(keys)) + 1)).astype(np.int64)
            counts = np.bincount(place, minlength=int(SPACE * len(keys)) + 1)
            levels.append(counts == 1)
            keys = keys[counts[place] != 1]
        if len(keys):
            raise ValueError("keys are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has it."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            place = (W.mix(keys[open_] ^ _SEEDS[k]) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            out[open_[hit]] = self.before[k] + self.ranks[k][place[hit]] - 1
            open_ = open_[~hit]
        return out


def _close(stream, dtype: str, tokens: int, ends: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
    """Write everything after the ids."""
    keyed = np.flatnonzero(~null)
    keys, first, rows = np.unique(ids[keyed], return_index=True, return_counts=True)
    keys = keys.astype(np.int64).view(np.uint64)
    table = PerfectHash.build(keys)
    slot = table.slots(keys)
    finger, at, number = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
    finger[slot], at[slot], number[slot] = fingerprint(keys), keyed[first] if len(keyed) else first, rows
    parts = {"ends": ends.astype("<u8"), "doc_ids": ids.astype("<i8"), "null": null.astype("u1")}
    parts |= {"bits": np.concatenate([np.packbits(b) for b in table.levels]) if table.levels else np.empty(0, np.uint8)}
    parts |= {"finger": finger.astype("<u4"), "first": at.astype("<u4"), "number": number.astype("<u4")}
    place, places = tokens * np.dtype(dtype).itemsize, {}
    for name, values in parts.items():
        stream.write(values.tobytes())
        places[name] = [place, len(values), values.dtype.str]
        place += values.nbytes
    trailer = json.dumps({"dtype": dtype, "tokens": tokens, "levels": [len(b) for b in table.levels], "parts": places}).encode()
    stream.write(trailer + len(trailer).to_bytes(4, "little") + MAGIC)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write all documents; returns the table of shards, ``start`` being the ids before each."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # The hash of the text splits an id that very many rows share.
    spread = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(max(1, -(-size // shard_bytes)), *spread).sortWithinPartitions(*spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = enc.encoder(tokenizer)
        dtype = "<u2" if max(coder.size - 1, end_id) < 1 << 16 else "<u4"
        shard, name = TaskContext.get().partitionId(), None
        stream, tokens, ends, ids, null = None, 0, [], [], []
        for batch in batches:
            for part in W.chunks(batch, size=CHUNK):
                if stream is None:
                    fs, folder = filesystem(path)
                    fs.create_dir(folder)
                    name = f"ids-{shard:06d}-{uuid.uuid4().hex}.bin"
                    stream = fs.open_output_stream(f"{folder}/{name}")
                flat, first = coder.encode(part.column("text"))
                number = np.diff(first) + 1
                last = np.cumsum(number)
                out = np.full(int(last[-1]), end_id, dtype)
                body = np.ones(len(out), bool)
                body[last - 1] = False
                out[body] = flat
                stream.write(out.tobytes())
                ends.append(tokens + last)
                tokens += len(out)
                ids.append(part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))
                null.append(part.column("doc_id").is_null().to_numpy(zero_copy_only=False))
        if stream is None:
            return
        all_ids, all_null = np.concatenate(ids), np.concatenate(null)
        _close(stream, dtype, tokens, np.concatenate(ends), all_ids, all_null)
        stream.close()
        known = all_ids[~all_null]
        span = [int(known.min()), int(known.max())] if len(known) else [None, None]
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "file": f"{path}/{name}", "rows": len(all_ids), "tokens": tokens, "lo": span[0], "hi": span[1]}],
            pa.schema([("shard", pa.int32()), ("file", pa.string()), ("rows", pa.int64()), ("tokens", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())]),
        )

    shards = scratch.materialise(rows.mapInArrow(run, SHARDS), "shards")
    before = F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")  # one short row per file
    return scratch.materialise(shards.select("*", before.alias("start")), "shards")


class ShardFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"not a shard file: {uri}")
        length = int.from_bytes(tail[:4], "little")
        self.info = json.loads(self.file.read_at(length, size - 12 - length))
        part = {name: np.frombuffer(self.file.read_at(n * np.dtype(kind).itemsize, at), kind) for name, (at, n, kind) in self.info["parts"].items()}
        self.ends = np.concatenate([[0], part["ends"]]).astype(np.int64)
        self.doc_ids, self.null = part["doc_ids"], part["null"].astype(bool)
        self.finger, self.first, self.number = part["finger"], part["first"], part["number"]
        levels, at = [], 0
        for n in self.info["levels"]:
            width = -(-n // 8)
            levels.append(np.unpackbits(part["bits"][at : at + width], count=n).astype(bool))
            at += width
        self.table = PerfectHash(levels)

    def rows_of(self, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each id; 0 rows where the file lacks it."""
        keys = doc_ids.astype(np.int64).view(np.uint64)
        slot = self.table.slots(keys)
        known = slot >= 0
        known[known] = self.finger[slot[known]] == fingerprint(keys[known])
        safe = np.where(known, slot, 0)
        if not len(self.first):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        return self.first[safe].astype(np.int64) * known, self.number[safe].astype(np.int64) * known

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids from place ``first`` up to ``last``, as u32."""
        kind = np.dtype(self.info["dtype"])
        return np.frombuffer(self.file.read_at((last - first) * kind.itemsize, first * kind.itemsize), kind).astype("<u4")


def read(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every row of the files, each found by its key."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                file = ShardFile(shard["file"])
                keys = np.unique(file.doc_ids[~file.null])
                first, number = file.rows_of(keys)
                rows = np.repeat(first - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum()) if len(keys) else np.empty(0, np.int64)
                rows = np.concatenate([np.flatnonzero(file.null), rows]).astype(np.int64)
                at = 0
                while at < len(rows):
                    # A run of neighbouring rows of bounded size is read at once.
                    stop = at + 1
                    while stop < len(rows) and rows[stop] == rows[stop - 1] + 1 and file.ends[rows[stop] + 1] - file.ends[rows[at]] <= READ_IDS:
                        stop += 1
                    base = int(file.ends[rows[at]])
                    ids = file.ids(base, int(file.ends[rows[stop - 1] + 1]))
                    some = rows[at:stop]
                    begin, end = file.ends[some], file.ends[some + 1]
                    crc = [zlib.crc32(ids[a - base : b - base]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(file.doc_ids[some], pa.int64(), mask=file.null[some]), pa.array(begin + shard["start"]), pa.array(end - begin), pa.array(crc, pa.int64()),
                    ], ["doc_id", "start", "n_tokens", "ids_crc32"])
                    at = stop

    n = max(1, min(shards.count(), shards.sparkSession.sparkContext.defaultParallelism * 4))
    return shards.repartition(n, F.xxhash64("shard")).mapInArrow(run, schema)


def lookup(shards: DataFrame, keys: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of the rows of the given ids; ids the files lack give no row.

    The bounds of the files, two numbers each, go to every task; keys meet on the
    file that may hold them.
    """
    bounds = [tuple(r) for r in shards.filter("lo is not null").orderBy("shard").select("lo", "hi", "file").collect()]
    shared = keys.sparkSession.sparkContext.broadcast(bounds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lo, hi = np.array([b[0] for b in shared.value], np.int64), np.array([b[1] for b in shared.value], np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            first, last = np.searchsorted(hi, ids, "left"), np.searchsorted(lo, ids, "right")
            number = np.maximum(last - first, 0)
            of = np.repeat(first - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum()) if len(ids) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, number), pa.int64()), pa.array(of.astype(np.int32))], ["doc_id", "file"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = -1, None
        for batch in batches:
            ids, files = batch.column("doc_id").to_numpy(), batch.column("file").to_numpy()
            out_ids, out = [], []
            for n in np.unique(files):
                if n != name:
                    name, file = n, ShardFile(shared.value[n][2])
                own = ids[files == n]
                for key, first, number in zip(own.tolist(), *[x.tolist() for x in file.rows_of(own)], strict=True):
                    for row in range(first, first + number):
                        out_ids.append(key)
                        out.append(file.ids(int(file.ends[row]), int(file.ends[row + 1])).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out_ids, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "ids"])

    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    placed = wanted.mapInArrow(place, "doc_id long, file int")
    return placed.repartition("file").sortWithinPartitions("file", "doc_id").mapInArrow(fetch, "doc_id long, ids array<long>")
