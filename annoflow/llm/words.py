"""Words of many texts at once, as numpy arrays over the UTF-8 bytes.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased:
digits, a-z and everything beyond ASCII.  All bytes of a character beyond ASCII
are 0x80 or more, so a run of characters is a run of bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True

_BASE = 0x9E3779B97F4A7C15
_STEP = 0xD6E8FEB86659FD93


@dataclass
class Words:
    """``data``: lower-cased bytes; word w is ``data[start[w]:end[w]]``, with a 64-bit
    hash; the words of text t are ``first[t]`` up to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, lo: int, hi: int) -> str:
        """Words lo up to hi, separated by single spaces."""
        return " ".join(self.data[self.start[i]:self.end[i]].tobytes().decode() for i in range(lo, hi))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Folds the bytes of all words of one length class at once, eight bytes a step."""
    out = np.full(len(start), _BASE, dtype=np.uint64)
    size = end - start
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    window = np.lib.stride_tricks.sliding_window_view(padded, 8)
    live, at = np.arange(len(start)), 0
    while len(live):
        chunk = np.ascontiguousarray(window[start[live] + at]).view(np.uint64).ravel()
        left = np.minimum(size[live] - at, 8).astype(np.uint64)
        short = left < 8
        chunk[short] &= (np.uint64(1) << (left[short] * np.uint64(8))) - np.uint64(1)
        out[live] = _mixed((out[live] ^ chunk) * np.uint64(_STEP) + left)
        at += 8
        live = live[size[live] > at]
    return out


def words_of(texts: pa.Array, hashed: bool = True) -> Words:
    """Words of an Arrow string array; a null text has none.  ``hashed=False`` leaves their hashes out."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[bounds[0]:bounds[-1]] if raw is not None and len(bounds) else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    data = _LOWER[data]
    inside = _IS_WORD[data]
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(0, np.uint64))
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    inner = bounds[1:-1]
    cut = inner[(inner > 0) & (inner < n)]
    opens[cut] = inside[cut]
    closes[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, bounds),
                 _word_hashes(data, start, end) if hashed else np.zeros(0, np.uint64))


def word_strings(w: Words) -> pa.Array:
    """All words as an Arrow string array."""
    size = w.end - w.start
    ends = np.cumsum(size)
    # The bytes of all words in a row: each word's first byte, then steps of one.
    at = np.ones(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    if len(ends):
        at[0] = w.start[0]
        at[ends[:-1]] = w.start[1:] - w.end[:-1] + 1
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(w.data[np.cumsum(at)]))


def shingle_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all k-word shingles that lie in one text, and their first words."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(n - k + 1, _BASE + k & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for j in range(k):
        h = _mixed((h ^ w.hash[j:n - k + 1 + j]) * np.uint64(_STEP))
    inside = np.ones(n - k + 1, dtype=bool)
    for j in range(1, k):  # a shingle must not run over the end of its text
        over = w.first[1:-1] - j
        inside[over[(over >= 0) & (over <= n - k)]] = False
    at = np.flatnonzero(inside)
    return h[at], at
