"""Vectorised helpers on Arrow text columns: word bounds, rolling hashes, window anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = U(0x9E6C63D0876A9A6B)
LOW = U(0xFFFFFFFF)
HIGH = U(0xFFFFFFFF00000000)
SPACES = [0x20, *range(0x09, 0x0E)]

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[SPACES] = False

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 20)
        inverse = U(pow(int(BASE), -1, 1 << 64))
        _powers[:] = [np.concatenate(([U(1)], np.cumprod(np.full(size - 1, b, U)))) for b in (BASE, inverse)]
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over the whole word."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit symbols, from one prefix sum."""

    def __init__(self, symbols: np.ndarray):
        up, self.down = powers(len(symbols) + 1)
        self.prefix = np.zeros(len(symbols) + 1, U)
        np.cumsum(symbols.astype(U) * up[:-1], out=self.prefix[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def every(self, size: int) -> np.ndarray:
        """The hash of each stretch of ``size`` symbols, by its start."""
        n = len(self.prefix) - size
        return mix((self.prefix[size:] - self.prefix[:n]) * self.down[:n]) if n > 0 else np.zeros(0, U)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """(first row, end row, UTF-8 bytes, offsets) of stretches of about ``limit`` bytes; a longer text stands alone."""
    text = batch.column(column)
    text = text.cast(pa.large_string()) if not pa.types.is_large_string(text.type) else text
    buffers = text.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes with ``inside``; no run crosses an offset."""
    held = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros_like(held), np.zeros_like(held)
    before[1:], after[:-1] = held[:-1], held[1:]
    return np.flatnonzero(held & (~before | edge[:-1])), np.flatnonzero(held & (~after | edge[1:])) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Rolling(data.astype(U) + U(1)).stretch(starts, ends)


def window_runs(rolling: Rolling, owner: np.ndarray, size: int, gram: int):
    """Runs of neighbouring windows (``size`` symbols, one owner) that share the place of their least gram.

    Returns start, number of windows and gram hash of each run. The least gram depends on the window's content
    alone, so equal windows lie in runs with the same gram hash.
    """
    grams = rolling.every(gram)
    n = len(owner) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    keys = (grams & HIGH) | np.arange(len(grams), dtype=U)
    place = sliding_min(keys, size - gram + 1) & LOW
    valid = owner[:n] == owner[size - 1:]
    joined = np.zeros(n + 1, bool)
    joined[1:n] = valid[1:] & valid[:-1] & (place[1:] == place[:-1])
    start = np.flatnonzero(valid & ~joined[:n])
    end = np.flatnonzero(valid & ~joined[1:]) + 1
    return start, end - start, grams[place[start].astype(np.int64)]
