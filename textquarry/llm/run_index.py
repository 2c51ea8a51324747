"""A run-length index of strings: run-compressed Burrows-Wheeler transform with suffix samples at the run ends."""

from __future__ import annotations

import numpy as np

PACKED = 4
PLACE_BITS = 28


def suffix_classes(text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of ``text``, and the ranks at which a new class of suffixes with equal first ``width`` symbols starts.

    Symbol 0 ends a string; ends compare below all symbols and by place among themselves, so comparisons stay within
    strings. Prefix doubling; a round sorts only suffixes that are still tied.
    """
    n, depth = len(text), min(PACKED, width)
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(depth):
        symbol = np.zeros(n, np.uint64)
        symbol[:max(0, n - k)] = text[k:]
        symbol[left < k] = 0
        key = (key << np.uint64(9)) | symbol
    packed = np.sort((key << np.uint64(PLACE_BITS)) | np.arange(n, dtype=np.uint64))
    order = (packed & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    key = packed >> np.uint64(PLACE_BITS)
    fresh = np.ones(n, bool)
    fresh[1:] = (key[1:] != key[:-1]) | (left[order][1:] < depth)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    heads, pair = np.ones(n, bool), None
    full = left >= width
    while True:
        if pair is None and depth <= width <= 2 * depth:
            pair = np.full((2, n), -1, np.int64)
            pair[0, full] = rank[full]
            pair[1, full] = rank[np.flatnonzero(full) + width - depth]
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        part = order[slots]
        by = (rank[part].astype(np.uint64) << np.uint64(32)) | rank[part + depth].astype(np.uint64)
        moved = np.argsort(by)
        by = by[moved]
        order[slots] = part[moved]
        fresh[slots[1:]] |= by[1:] != by[:-1]
        rank[order[slots]] = np.maximum.accumulate(np.where(fresh[slots], slots, 0))
        depth *= 2
    if pair is not None:
        a, b = order[1:], order[:-1]
        heads[1:] = (pair[0, a] != pair[0, b]) | (pair[1, a] != pair[1, b]) | (pair[0, a] < 0)
    return order, np.flatnonzero(heads)


class RunIndex:
    """Index of byte strings; a place is an offset into their concatenation, each string followed by its end."""

    def __init__(self, strings: list[bytes], width: int):
        self.text, self.begins = joined(strings)
        order, self.class_rank = suffix_classes(self.text, width)
        self.class_first = np.minimum.reduceat(order, self.class_rank)
        before = self.text[order - 1]
        self.run_rank = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.run_symbol = before[self.run_rank].astype(np.int64)
        self.run_last = np.append(self.run_rank[1:], len(before)) - 1
        self.sample_first, self.sample_last = order[self.run_rank], order[self.run_last]
        self.by_symbol = np.argsort(self.run_symbol, kind="stable")
        sizes = (self.run_last - self.run_rank + 1)[self.by_symbol]
        self.goes_to = np.empty(len(sizes), np.int64)
        self.goes_to[self.by_symbol] = np.cumsum(sizes) - sizes
        self.symbol_run = self.run_symbol[self.by_symbol] * len(sizes) + self.by_symbol

    def _common(self, text, at, sample, most):
        """Length of the common prefix of text[at:] and the indexed text at ``sample``, at most ``most``."""
        length, open_ = np.zeros(len(at), np.int64), np.flatnonzero(most > 0)
        while len(open_):
            step = length[open_]
            same = text[at[open_] + step] == self.text[sample[open_] + step]
            open_ = open_[same]
            length[open_] += 1
            open_ = open_[length[open_] < most[open_]]
        return length

    def statistics(self, text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the strings of ``text``: at each place the longest match in the index, and the rank of one.

        All strings advance together from their ends to their starts, one symbol a step. Where the transform continues
        with another symbol, the nearest runs of the right symbol give the best rank, and their samples the length.
        """
        length, rank = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        sizes, runs = np.diff(begins) - 1, len(self.run_rank)
        strings = np.argsort(-sizes, kind="stable")
        row, held = np.zeros(len(strings), np.int64), np.zeros(len(strings), np.int64)
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes[strings], -step, "left"))
            at = begins[strings[:live] + 1] - 2 - step
            symbol = text[at].astype(np.int64)
            here, size = row[:live], held[:live]
            run = np.searchsorted(self.run_rank, here, "right") - 1
            lost = np.flatnonzero(self.run_symbol[run] != symbol)
            if len(lost):
                slot = np.searchsorted(self.symbol_run, symbol[lost] * runs + run[lost])
                best = np.full(len(lost), -1, np.int64)
                for turn, side in ((slot, 0), (slot - 1, 1)):
                    near = self.by_symbol[np.clip(turn, 0, runs - 1)]
                    there = (turn >= 0) & (turn < runs) & (self.run_symbol[near] == symbol[lost])
                    sample = self.sample_last[near] if side else self.sample_first[near]
                    common = np.where(there, self._common(text, at[lost] + 1, sample, np.where(there, size[lost], 0)), -1)
                    wins = common > best
                    run[lost[wins]] = near[wins]
                    here[lost[wins]] = (self.run_last if side else self.run_rank)[near[wins]]
                    best[wins] = common[wins]
                size[lost] = best
            row[:live] = np.where(size < 0, 0, self.goes_to[run] + here - self.run_rank[run])
            held[:live] = size + 1
            length[at], rank[at] = held[:live], row[:live]
        return length, rank

    def earliest(self, rank: np.ndarray) -> np.ndarray:
        """The first place whose ``width`` symbols equal those of the suffixes of ``rank``."""
        return self.class_first[np.searchsorted(self.class_rank, rank, "right") - 1]


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (byte + 1) of the strings with a 0 after each, and where each starts (with a last bound)."""
    begins = np.concatenate(([0], np.cumsum([len(s) + 1 for s in strings])))
    text = np.zeros(begins[-1], np.int16)
    inside = np.ones(len(text), bool)
    inside[begins[1:] - 1] = False
    text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
    return text, begins
