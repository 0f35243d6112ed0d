"""Vectorised hashing of words and substrings over Arrow batches of text.

A slice of a batch is one buffer of UTF-8 bytes with the offsets of its texts.
Substring hashes come from one prefix sum: with an odd multiplier ``M``,
``sum(T[byte] * M**position)`` over a range, times ``M**-start``, depends on
the bytes alone.  All arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_M, -1, 1 << 64)
#: fixed values: the bytes between words ``[^\x20\x09-\x0D]+``
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def byte_table(seed: int, fold_case: bool = False) -> np.ndarray:
    """A random uint64 per byte; A-Z as a-z when ``fold_case``."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_M) + np.uint64(seed * 0x1000193 + 1))
    if fold_case:
        table[0x41:0x5B] = table[0x61:0x7B]
    return table


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1); kept for the next slice."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


class Hashes:
    """Hashes of the substrings of one buffer."""

    def __init__(self, buf: np.ndarray, table: np.ndarray):
        n = len(buf)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[buf] * _powers(_M, n), out=self._sums[1:])
        self._down = _powers(_INVERSE, n + 1)

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all substrings of ``size`` bytes, as ``of`` has them."""
        n = len(self._sums) - size
        out = self._sums[size:] - self._sums[:n]
        out *= self._down[:n]
        out += np.uint64(size * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
        return mix(out)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self._sums[stop] - self._sums[start]) * self._down[start]
                   + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return buf, offsets - offsets[0]


def slices(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text each (one long text is a range of its own)."""
    _, offsets = utf8(column)
    i, n = 0, len(column)
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def word_spans(buf: np.ndarray, offsets: np.ndarray, separators: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and stop of every word, and the text it is in; words end where their text ends."""
    n = len(buf)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    is_word = np.ones(256, dtype=bool)
    is_word[list(separators)] = False
    inside = is_word[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    return start, stop, text
