"""Numeric features of whole texts, computed for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pageloom.llm import words as W

NAMES = [
    "log_words", "symbols", "capitals", "digits", "exclamations", "pipes", "word_bytes", "distinct_words",
    "repeated_lines", "repeated_runs", "stops", "beyond_ascii", "words_per_line", "short_words", "bracket_or_quote",
]


def _flags(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_CLASSES = {
    "symbols": _flags("#*$%&|<>"), "capitals": _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _flags("0123456789"),
    "exclamations": _flags("!?"), "pipes": _flags("|"), "stops": _flags(".,;:"), "bracket_or_quote": _flags("()[]{}\"'=_/@"),
}
_BEYOND = np.arange(256) >= 128
_TEXT_BITS = np.uint64(44)


def _counts(flags: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags[raw], dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct values per text, by 44 bits of their hashes."""
    n = len(first) - 1
    text = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    keys = np.sort((text << _TEXT_BITS) | (hashes >> np.uint64(20)))
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[fresh] >> _TEXT_BITS).astype(np.int64), minlength=n)


def _lines(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines that hold a word, and their offsets per text."""
    raw, offsets = words.raw, words.offsets
    breaks = np.union1d(np.flatnonzero(raw == 10), offsets[1:])
    line = np.searchsorted(breaks, words.start, "right")
    used = np.unique(line)
    end = np.minimum(breaks[used], len(raw))
    before = np.where(used > 0, breaks[used - 1], 0)
    start = np.where((used > 0) & (before < len(raw)), before + (raw[np.minimum(before, max(len(raw) - 1, 0))] == 10), before)
    start = np.maximum(start, offsets[np.searchsorted(offsets, before, "right") - 1])
    return W.range_hash(raw, start, end), np.searchsorted(start, offsets)


def measure(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text; an empty text has zeros."""
    words = W.Words(texts)
    n = words.counts
    share = np.maximum(n, 1)
    length = words.end - words.start
    body = np.maximum(W.per_text(np.add, length, words.first, 0), 1)
    out = {name: _counts(flags, words.raw, words.offsets) / body for name, flags in _CLASSES.items()}
    shingles, at = words.shingles()
    out["log_words"] = np.log1p(n)
    out["word_bytes"] = body / share * (n > 0)
    out["distinct_words"] = distinct(words.hash, words.first) / share
    out["repeated_runs"] = 1 - distinct(shingles, at) / np.maximum(np.diff(at), 1)
    lines, of = _lines(words)
    number = np.diff(of)
    out["repeated_lines"] = 1 - distinct(lines, of) / np.maximum(number, 1)
    out["words_per_line"] = np.log1p(n / np.maximum(number, 1))
    out["beyond_ascii"] = _counts(_BEYOND, words.raw, words.offsets) / body
    out["short_words"] = W.per_text(np.add, (length <= 3).astype(np.int64), words.first, 0) / share
    matrix = np.column_stack([out[name] for name in NAMES])
    matrix[n == 0] = 0
    return matrix
