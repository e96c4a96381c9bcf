"""Words of whole texts as 64-bit hashes, for the operators that work on word sequences.

A word is a longest run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z only: digits,
letters and everything outside ASCII. In UTF-8 every byte of such a character is at least 0x80, so
the texts are scanned as bytes. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are scanned at once; a slice ends between words, so the cut changes nothing.
SLICE_BYTES = 1 << 20
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_BYTES = np.arange(256)
_IS_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = np.where(_IS_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
_IS_WORD = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
    | _IS_UPPER
)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and its inverse, made once per worker and as far as needed."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and the place where each begins (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, ends, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    places = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    begin, n = 0, len(data)
    while begin < n:
        end = min(n, begin + SLICE_BYTES)
        while end < n and _IS_WORD[data[end]]:  # a word may not be cut
            end += 1
        yield begin, end
        begin = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin (one more at the end)."""
    data, places = buffers(texts)
    hashes, begins = [], []
    for lo, hi in _cuts(data):
        part = data[lo:hi]
        inside = _IS_WORD[part]
        edges = places[np.searchsorted(places, lo) : np.searchsorted(places, hi)] - lo
        before = np.concatenate(([False], inside[:-1]))
        before[edges] = False
        first = np.flatnonzero(inside & ~before)
        after = np.concatenate((inside[1:], [False]))
        after[edges[edges > 0] - 1] = False
        last = np.flatnonzero(inside & ~after)
        up, down = _Powers.of(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=total[1:])
        value = (total[last + 1] - total[first]) * down[first]
        hashes.append(np.maximum(mix(value + (last - first).astype(np.uint64)), np.uint64(1)))
        begins.append(first + lo)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(places), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), places)


def row_slices(texts: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``limit`` bytes of text; a longer text is a run of its own."""
    sizes = np.cumsum(np.diff(buffers(texts)[1]))
    begin, done = 0, 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield begin, end
        begin, done = end, int(sizes[end - 1])
