"""Words of many texts at once, as numpy arrays over Arrow's own buffers.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  Words are
known by a 64-bit hash of their bytes: per-byte random values in a polynomial
whose prefix sums give the hash of any range of bytes at once, then mixed.
Two different words share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
CHUNK_BYTES = 1 << 20

_U = np.uint64
MASK = 2**64 - 1
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))
_PLACE = _RNG.integers(1, 2**63, 8, dtype=np.uint64) | _U(1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = {"up": np.empty(0, np.uint64), "down": np.empty(0, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POWERS["up"], _POWERS["down"] = _powers(size, _BASE), _powers(size, _INVERSE)
    return _POWERS["up"], _POWERS["down"]


def range_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range ``[start, end)``."""
    up, down = powers(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its texts; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text; a longer text is a slice of its own."""
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """Words of a string array: ``hash``, byte range, and ``first[i]:first[i + 1]`` of text i."""

    def __init__(self, texts: pa.Array):
        self.raw, self.offsets = text_bytes(texts)
        inside = ~IS_SPACE[self.raw]
        opens, shuts = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        shuts[:-1] &= ~inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(self.raw))]
        opens[edges] = inside[edges]
        shuts[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(shuts) + 1
        self.hash = range_hash(self.raw, self.start, self.end)
        self.first = np.searchsorted(self.start, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words and the offsets per text.

        A text of fewer words, but at least one, has its whole sequence as its
        only shingle; a text without words has none.
        """
        n = self.counts
        number = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        first = np.concatenate([[0], np.cumsum(number)])
        out = np.empty(first[-1], np.uint64)
        m = max(len(self.hash) - size + 1, 0)
        runs = np.zeros(m, np.uint64)
        for k in range(size):
            runs += self.hash[k : k + m] * _PLACE[k]
        long = n >= size
        at = np.repeat(self.first[:-1][long] - np.concatenate([[0], np.cumsum(number[long])[:-1]]), number[long]) + np.arange(number[long].sum())
        out[np.repeat(long, number)] = mix(runs[at])
        for i in np.flatnonzero(~long & (n > 0)):
            own = self.hash[self.first[i] : self.first[i + 1]]
            out[first[i]] = mix(np.array([int((own * _PLACE[: len(own)]).sum(dtype=np.uint64)) + len(own) & MASK], np.uint64))[0]
        return out, first


def per_text(ufunc: np.ufunc, values: np.ndarray, first: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` reduced over each text's values; ``empty`` where it has none."""
    out = np.full(len(first) - 1, empty, values.dtype)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = ufunc.reduceat(values, first[some])
    return out
