"""Words of whole Arrow batches at once, on the UTF-8 bytes.

Both word patterns of this package split on ASCII only, so bytes and characters
give the same words. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_WEIGHT = _RNG.integers(1, 2**63, 32, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_VALUE = _BYTE_VALUE[LOWER]

_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x41:0x5B] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True

#: "space": runs of anything but ASCII white space; "alnum": runs of digits,
#: ASCII letters and whatever is not ASCII.
WORD_BYTES = {"space": _NOT_SPACE, "alnum": _ALNUM}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over all 64 bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, pow(_BASE, -1, 2**64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), off


class Words:
    """Words of some rows: byte spans, hashes, and the first word of each row."""

    def __init__(self, data: np.ndarray, off: np.ndarray, kind: str):
        self.data, self.off = data, off
        inside = WORD_BYTES[kind][data]
        n = len(data)
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            heads = off[:-1]
            before[heads[heads < n]] = False
            tails = off[1:] - 1
            after[tails[tails >= 0]] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.rows = np.searchsorted(self.starts, off)  # words of row i: rows[i]..rows[i+1]

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = _powers(max(1 << 21, 1 << int(len(self.data)).bit_length()))
        total = np.empty(len(self.data) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE_VALUE[self.data] * up[: len(self.data)], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * down[self.starts]
        return mix(h + (self.ends - self.starts).astype(np.uint64))


def pieces(column, kind: str, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words), each of about ``most_bytes`` or one long row."""
    return pieces_of(*text_buffers(column), kind, most_bytes)


def pieces_of(data: np.ndarray, off: np.ndarray, kind: str, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    n = len(off) - 1
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + most_bytes, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b, Words(data[off[a] : off[b]], off[a : b + 1] - off[a], kind)
        a = b


def kgrams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for every k consecutive entries, rows not minded."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n] * _ORDER[0]
    for i in range(1, k):
        h = h + words[i : i + n] * _ORDER[i]
    return mix(h)


def row_sequence_hash(words: np.ndarray) -> int:
    """One hash for a whole sequence shorter than a window."""
    h = (words * _ORDER[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
    return int(mix(np.array([h], dtype=np.uint64))[0])
