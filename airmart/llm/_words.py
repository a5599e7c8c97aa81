"""Vectorised word splitting and hashing for Arrow batches of texts.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``; no byte of a
multi-byte UTF-8 sequence falls in that class, so byte offsets are enough.
Batches are processed in slices of bounded size (one text is never split), so
a task's memory is bounded by ``SLICE_BYTES`` and its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_P = int(_RNG.integers(1 << 61, 1 << 62, dtype=np.uint64)) * 2 + 1
_PINV = pow(_P, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n (kept per worker, grown when a longer text comes)."""
    if len(_POWERS.get("p", ())) < n:
        n = max(n, SLICE_BYTES + 4096)
        for key, base in (("p", _P), ("q", _PINV)):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            _POWERS[key] = np.multiply.accumulate(out)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (splitmix constants); a new array of well spread values."""
    x = x + _U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Words:
    """Words of a slice of texts: byte ``start``/``end`` into ``data``, ``doc`` (row in the slice) and
    ``first`` (index of each row's first word, with a closing entry)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets, n = _LOWER[data] if lower else data, offsets, len(data)
        word = np.ones(n + 1, dtype=bool)
        word[n] = False
        word[:n] = ~_SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        start = word.copy()
        start[1:] &= ~word[:-1] | edge[1:]
        stop = word[:n] & (~word[1:] | edge[1:])
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def bytes(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        p, q = _powers(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * p[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * q[self.start] + (self.end - self.start).astype(np.uint64))

    def rows_left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return self.first[1:][self.doc] - np.arange(len(self.start))


def grams(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each n consecutive entries of h (runs over text borders; the caller masks them)."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(h) - n + 1
    out = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        out += (h[j:j + m] ^ (h[j:j + m] >> _U(29))) * _STEP[(j + seed) % 64]
    return mix(out, seed + n)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about ``limit`` text bytes: (rows, bytes, offsets). A null text counts as empty."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    total, lo, n = np.concatenate(([0], np.cumsum(lengths))), 0, len(lengths)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + limit, side="right")) - 1)
        part = batch.slice(lo, hi - lo)
        col = part.column(column)
        if col.null_count:
            col = pa.compute.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
        wide = np.int64 if pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type) else np.int32
        off = np.frombuffer(col.buffers()[1], dtype=wide)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, dtype=np.uint8)
        yield part, data, off - off[0]
        lo = hi
