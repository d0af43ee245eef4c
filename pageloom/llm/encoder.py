"""Fast use of a byte-level BPE tokenizer: each distinct piece of a text is encoded once.

The tokenizer cuts a text into pieces before it merges bytes.  It always cuts
before a space that a visible character follows, and before a space that follows
one, so parts that begin at spaces can be encoded alone and their ids put one
after another.  Texts where this does not hold (a space between white space,
white space beyond ASCII, marks of special tokens) are encoded whole.  Distinct
parts are kept in a table per worker of bounded size; it only saves work.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from pageloom.llm import words as W

KEPT_PARTS = 1_500_000
JOINED = 4000
_SPACE = 32


class Encoder:
    """Ids of texts, as ``tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.length = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def _each(self, parts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _joined(self, parts: list[str]) -> list[np.ndarray]:
        """Parts that begin with a space before a visible character."""
        out: list[np.ndarray] = []
        for k in range(0, len(parts), JOINED):
            some = parts[k : k + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            starts = np.flatnonzero(self.opens[ids])
            out += np.split(ids, starts[1:]) if len(starts) == len(some) and starts[0] == 0 else self._each(some)
        return out

    def _learn(self, raw: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        data = raw.tobytes()
        second = raw[np.minimum(start + 1, len(raw) - 1)]
        plain = (raw[start] == _SPACE) & (end - start > 1) & ~W.IS_SPACE[second]
        lists: list[np.ndarray] = [None] * len(keys)  # type: ignore[list-item]
        for chosen, encode in ((np.flatnonzero(plain), self._joined), (np.flatnonzero(~plain), self._each)):
            if len(chosen):
                for i, ids in zip(chosen, encode([data[start[i] : end[i]].decode() for i in chosen]), strict=True):
                    lists[i] = ids
        length = np.array([len(x) for x in lists], np.int64)
        at = len(self.pool) + np.concatenate([[0], np.cumsum(length)[:-1]])
        self.pool = np.concatenate([self.pool, *lists])
        keys, at, length = np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.length, length])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.length = keys[order], at[order], length[order]

    @staticmethod
    def _irregular(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that must be encoded whole."""
        n = len(raw)
        bad = np.zeros(n, bool)
        if n:
            space = W.IS_SPACE[raw]
            before, after = np.zeros(n, bool), np.zeros(n, bool)
            before[1:], after[:-1] = space[:-1], space[1:]
            inner = offsets[(offsets > 0) & (offsets < n)]
            before[inner] = False
            after[inner - 1] = True
            after[n - 1] = True
            bad |= (raw == _SPACE) & before & after
            next1, next2 = np.append(raw[1:], 0), np.append(raw[2:], [0, 0])[:n]
            bad |= (raw == ord("<")) & (next1 == ord("|"))
            bad |= (raw == 0xC2) & ((next1 == 0xA0) | (next1 == 0x85))
            bad |= (raw == 0xE1) & (next1 == 0x9A) & (next2 == 0x80)
            bad |= (raw == 0xE2) & (next1 == 0x80) & ((next2 <= 0x8A) | (next2 == 0xA8) | (next2 == 0xA9) | (next2 == 0xAF))
            bad |= (raw == 0xE2) & (next1 == 0x81) & (next2 == 0x9F)
            bad |= (raw == 0xE3) & (next1 == 0x80) & (next2 == 0x80)
            bad |= (raw >= 28) & (raw <= 31)
        total = np.concatenate([[0], np.cumsum(bad)])
        return total[offsets[1:]] > total[offsets[:-1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts and their offsets; a null text has none."""
        raw, offsets = W.text_bytes(texts)
        n = len(offsets) - 1
        whole = self._irregular(raw, offsets)
        opens = raw == _SPACE
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(opens)
        first = np.searchsorted(start, offsets)
        end = np.append(start[1:], len(raw)) if len(start) else start
        text = np.repeat(np.arange(n), np.diff(first))
        used = ~whole[text]
        start, end, text = start[used], end[used], text[used]
        keys = W.range_hash(raw, start, end)
        distinct, example, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        missing = np.ones(len(distinct), bool)
        if len(self.keys):
            missing = self.keys[np.minimum(at, len(self.keys) - 1)] != distinct
        if missing.any():
            if len(self.keys) + missing.sum() > KEPT_PARTS:
                self._clear()
                missing[:] = True
            chosen = example[missing]
            self._learn(raw, distinct[missing], start[chosen], end[chosen])
        at = np.searchsorted(self.keys, distinct)
        source, length = self.at[at][inverse] if len(at) else np.empty(0, np.int64), self.length[at][inverse] if len(at) else np.empty(0, np.int64)
        count = np.bincount(text, weights=length, minlength=n).astype(np.int64) if n else np.empty(0, np.int64)
        rest = {int(i): ids for i, ids in zip(np.flatnonzero(whole), self._each([texts[int(i)].as_py() for i in np.flatnonzero(whole)]), strict=True)} if whole.any() else {}
        for i, ids in rest.items():
            count[i] = len(ids)
        out_first = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(out_first[-1], np.uint32)
        piece_end = np.cumsum(length)
        gather = np.repeat(source - (piece_end - length), length) + np.arange(piece_end[-1] if len(piece_end) else 0)
        regular = np.repeat(~whole, count)
        out[regular] = self.pool[gather]
        for i, ids in rest.items():
            out[out_first[i] : out_first[i + 1]] = ids
        return out, out_first


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
