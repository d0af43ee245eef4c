"""Misra-Gries summaries per hash partition, and membership filters of bounded size.

Items are known by 64-bit hashes.  A hash has a code: its partition, and a key
of 24 bits within it.  Tasks fold their items into one packed row per partition;
partitions are then merged apart from each other, so no summary ever holds more
than its own share of the codes.  Codes may collide, which can only add to a
count: what is frequent always survives, and a later exact count drops the rest.

The codes that survive become a filter for the next pass over the corpus.  Each
partition fills its own segment; all segments together never exceed
``FILTER_BYTES``, however many survive.  A full filter lets more through, which
costs shuffle but no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.words import mix

KEY_BITS = 24
KEYS = np.uint64((1 << KEY_BITS) - 1)
MOST = 255  # a larger count is several entries
FILTER_BYTES = 32 << 20
BITS_EACH = 12
PROBES = 4
PACKED = "part int, ones binary, many binary"
SEGMENTS = "part int, bits binary"

_U = np.uint64


def parts_for(mass: int, least: int = 64) -> int:
    """Partitions that give every partition about as many items as it has keys."""
    return max(least, -(-int(mass) >> KEY_BITS))


def codes(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partition in the high bits, key in the low ones."""
    part = ((hashes >> _U(32)) * _U(parts)) >> _U(32)
    return (part << _U(KEY_BITS)) | (hashes & KEYS)


def _three_bytes(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _from_three_bytes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return out.view("<u4").ravel()


def pack(found: np.ndarray) -> pa.RecordBatch:
    """One row per partition: keys met once, and keys with a count byte."""
    if not len(found):
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int32(), pa.binary(), pa.binary())], ["part", "ones", "many"])
    found = np.sort(found)
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    number, own = np.diff(np.append(first, len(found))), found[first]
    part = (own >> _U(KEY_BITS)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    rows: list[tuple[int, bytes, bytes]] = []
    for start, stop in zip(edges, np.append(edges[1:], len(part)), strict=True):
        keys, n = own[start:stop] & KEYS, number[start:stop]
        times = -(-n // MOST)
        many = n > 1
        repeated, left = np.repeat(keys[many], times[many]), np.repeat(n[many], times[many])
        left -= MOST * (np.arange(len(left)) - np.repeat(np.cumsum(times[many]) - times[many], times[many]))
        rows.append((int(part[start]), _three_bytes(keys[~many]), _three_bytes(repeated) + np.minimum(left, MOST).astype(np.uint8).tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["part", "ones", "many"])


class Summary:
    """Misra-Gries counters of one partition; ``error`` bounds what any count may lack.

    The capacity exceeds the mass seen divided by the threshold, and a cut that
    would let the error reach the threshold makes room instead.
    """

    def __init__(self, threshold: int, capacity: int = 1 << 15):
        self.threshold, self.capacity = threshold, capacity
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.mass = self.error = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Merge counters; summaries of disjoint items merge in the same way."""
        self.mass += int(counts.sum())
        self.capacity = max(self.capacity, 2 * self.mass // self.threshold + 1)
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        self.keys = keys[first]
        self.counts = np.add.reduceat(counts[order], first) if len(first) else counts
        while len(self.keys) > self.capacity:
            cut = int(np.partition(self.counts, -(self.capacity + 1))[-(self.capacity + 1)])
            if self.error + cut >= self.threshold:
                self.capacity *= 2
                continue
            self.error += cut
            kept = self.counts > cut
            self.keys, self.counts = self.keys[kept], self.counts[kept] - cut

    def survivors(self) -> np.ndarray:
        """Keys whose true count may reach the threshold; none that reaches it is missing."""
        return self.keys[self.counts + self.error >= self.threshold]


def unpack(ones: bytes, many: bytes) -> tuple[np.ndarray, np.ndarray]:
    once, n = _from_three_bytes(ones), len(many) // 4
    keys = np.concatenate([once, _from_three_bytes(many[: 3 * n])])
    return keys, np.concatenate([np.ones(len(once), np.int64), np.frombuffer(many[3 * n :], np.uint8).astype(np.int64)])


def _probes(code: np.ndarray, size: np.ndarray | int) -> Iterator[np.ndarray]:
    spread = mix(code + _U(0x51ED270B7F4A7C15))
    low, high = spread & _U(0xFFFFFFFF), (spread >> _U(32)) | _U(1)
    for k in range(PROBES):
        yield (((low + _U(k) * high) & _U(0xFFFFFFFF)) * np.asarray(size, np.uint64)) >> _U(32)


class Filter:
    """Segments of all partitions, joined; ``keeps`` has no false negatives."""

    def __init__(self, parts: int, segments: list[tuple[int, bytes]]):
        self.parts = parts
        self.size, self.first = np.zeros(parts, np.uint64), np.zeros(parts, np.uint64)
        at = 0
        for part, bits in segments:
            self.size[part], self.first[part] = 8 * len(bits), 8 * at
            at += len(bits)
        self.bits = np.frombuffer(b"".join(bits for _, bits in segments) or b"\0", np.uint8)

    def keeps(self, hashes: np.ndarray) -> np.ndarray:
        code = codes(hashes, self.parts)
        part = (code >> _U(KEY_BITS)).astype(np.int64)
        size, first = self.size[part], self.first[part]
        out = size > 0
        for probe in _probes(code, size):
            at = first + probe
            out &= (self.bits[np.minimum(at >> _U(3), _U(len(self.bits) - 1)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1
        return out


def segment(part: int, keys: np.ndarray, limit: int) -> bytes:
    """Filter bits of one partition's keys, at most ``limit`` bytes."""
    size = 8 * min(-(-len(keys) * BITS_EACH // 8), limit)
    bits = np.zeros(size, bool)
    for probe in _probes((_U(part) << _U(KEY_BITS)) | keys.astype(np.uint64), size):
        bits[probe.astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def frequent(packed: DataFrame, parts: int, threshold: int) -> Filter:
    """A filter of all codes met ``threshold`` times or more in the packed rows."""
    limit = FILTER_BYTES // parts

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, part, waiting, size = Summary(threshold), None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                waiting.append(unpack(row["ones"], row["many"]))
                size += len(waiting[-1][0])
                if size > max(1 << 20, summary.capacity):
                    summary.add(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                    waiting, size = [], 0
        if waiting:
            summary.add(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
        keys = summary.survivors()
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([segment(part, keys, limit)], pa.binary())], ["part", "bits"])

    rows = packed.groupBy("part").applyInArrow(merge, SEGMENTS).collect()
    return Filter(parts, [(r["part"], bytes(r["bits"])) for r in rows])


def members(keys: DataFrame) -> Filter:
    """A filter of the hashes in the only column of ``keys``."""
    parts = parts_for(keys.count())

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pack(codes(batch.column(0).to_numpy().view(np.uint64), parts))

    return frequent(keys.mapInArrow(fold, PACKED), parts, 1)


def may_hold(shared, key: str) -> Column:
    """Whether a broadcast filter may hold the hash in ``key``."""

    @F.arrow_udf("boolean")
    def keeps(hashes: pa.Array) -> pa.Array:
        return pa.array(shared.value.keeps(hashes.to_numpy().view(np.uint64)))

    return keeps(F.col(key))
