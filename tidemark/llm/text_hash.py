"""Hashes of the words of many texts at once, as numpy arrays.

The texts of an Arrow batch lie in one byte buffer. A prefix sum of weighted bytes gives the
hash of every word by one subtraction, so no Python code runs per word or character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20
_ODD = U(0x9E3779B97F4A7C15)
_MIX = U(0xD6E8FEB86659FD93)
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 2**64, size=256, dtype=U)
_ORDER = _rng.integers(0, 2**63, size=16, dtype=U) * U(2) + U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# All but letters and digits; bytes of letters beyond ASCII belong to words.
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = PUNCTUATION[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the values over the whole word."""
    x = (x ^ (x >> U(32))) * _MIX
    x = (x ^ (x >> U(29))) * _ODD
    return x ^ (x >> U(32))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


_STEP = 0xC2B2AE3D27D4EB4F
_POW = _powers(_STEP, 2 * SLICE_BYTES)
_INV = _powers(_inverse(_STEP), 2 * SLICE_BYTES)


@dataclass
class Words:
    """Words of consecutive texts. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # byte offsets of each word
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    begin: int  # row of the first text in its batch
    text_begin: np.ndarray  # byte offset of each text, and the end

    @property
    def n_texts(self) -> int:
        return len(self.first) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), np.diff(self.first))


def word_slices(texts: pa.Array, lower: bool = False, blank: np.ndarray = _SPACE) -> Iterator[Words]:
    """Cut a column into slices of about a megabyte of whole texts; a null text is empty.

    ``blank`` marks the bytes between words; by default these are the white-space characters.
    """
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        stop = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        stop = min(n, max(stop, at + 1))
        yield _words(data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at], at, lower, blank)
        at = stop


def _words(data: np.ndarray, offsets: np.ndarray, begin: int, lower: bool, blanks: np.ndarray) -> Words:
    n = len(data)
    blank = blanks[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[1:] = blank[:-1]
    before[:1] = True
    start = np.flatnonzero(~blank & (before | edge[:n]))
    after = np.empty(n, dtype=bool)
    after[:-1] = blank[1:]
    after[-1:] = True
    end = np.flatnonzero(~blank & (after | edge[1:])) + 1
    power, inverse = _POW, _INV
    if n > len(power):
        power, inverse = _powers(_STEP, n), _powers(_inverse(_STEP), n)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * power[:n], out=sums[1:], dtype=U)
    hashes = mix((sums[end] - sums[start]) * inverse[start])
    return Words(data, start, end, hashes, np.searchsorted(start, offsets), begin, offsets)


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text, and where each text's runs begin.

    A text with fewer words, but at least one, has one run of all its words.
    """
    h, first = words.hash, words.first
    counts = np.diff(first)
    n = max(0, len(h) - size + 1)
    total = np.zeros(n, dtype=U)
    for k in range(size):
        total += h[k : k + n] * _ORDER[k]
    per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(per_text)])
    out = np.empty(begin[-1], dtype=U)
    whole = np.repeat(counts >= size, per_text)
    inside = np.repeat(first[:-1] - begin[:-1], per_text) + np.arange(begin[-1])
    out[whole] = mix(total[inside[whole]])
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        part = h[first[d] : first[d + 1]]
        out[begin[d]] = mix((part * _ORDER[: len(part)]).sum(dtype=U, keepdims=True) + U(len(part)))[0]
    return out, begin


def gram_sets(words: Words, size: int) -> list[np.ndarray]:
    """The distinct runs of each text, sorted."""
    values, begin = grams(words, size)
    return [np.unique(values[begin[d] : begin[d + 1]]) for d in range(words.n_texts)]
