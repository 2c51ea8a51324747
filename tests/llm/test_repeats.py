"""Repeated word windows and byte strings against brute force."""

import random

import numpy as np
import pytest

from textquarry.llm import run_index, sketch, substrings, suffixes

from .rows import awkward, empty, frame

LEAST = -(1 << 63)


def brute_words(rows, size):
    first = {}
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, 1 << 62), LEAST if i is None else i)
    out = []
    for i, t in rows:
        w, gone = (t or "").split(), set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < (LEAST if i is None else i):
                gone |= set(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [3, 20])
def test_words(spark, size):
    rows = awkward(size)
    got = substrings.remove_repeated_windows(frame(spark, rows), size, bits=10).collect()
    assert sorted(map(tuple, got), key=repr) == brute_words(rows, size)


def test_words_cases(spark):
    assert substrings.remove_repeated_windows(empty(spark)).count() == 0
    same = [(1, "a b c d"), (1, "a b c d"), (1, "a b c"), (2, "A b c d")]
    got = substrings.remove_repeated_windows(frame(spark, same), 3, bits=10).collect()
    assert sorted((r.doc_id, r.n_removed, r.kept) for r in got) == [(1, 0, "a b c"), (1, 0, "a b c d"), (1, 0, "a b c d"), (2, 3, "A")]


def brute_bytes(rows, size):
    seen, out = set(), []
    for i, t in sorted(set(rows), key=lambda r: (LEAST if r[0] is None else r[0])):
        b = (t or "").encode()
        gone, mine = np.zeros(len(b) + size, bool), set()
        for k in range(len(b) - size + 1):
            if b[k:k + size] in seen or b[k:k + size] in mine:
                gone[k:k + size] = True
            mine.add(b[k:k + size])
        seen |= mine
        gone = gone[:len(b)]
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out += [(i, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g))] * rows.count((i, t))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,hot", [(5, 20_000), (40, 20_000), (12, 0)])
def test_bytes(spark, size, hot):
    rows = awkward(size)
    got = suffixes.remove_repeated_strings(frame(spark, rows), size, bits=12, hot_runs=hot, block_bytes=64).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == brute_bytes(rows, size)


def test_bytes_empty(spark):
    assert suffixes.remove_repeated_strings(empty(spark)).count() == 0


@pytest.mark.parametrize("width", [2, 3, 6, 9])
def test_index(width):
    pick = random.Random(width)
    for _ in range(40):
        held = [bytes(pick.choice(b"ab\x00") for _ in range(pick.randint(1, 25))) for _ in range(pick.randint(1, 10))]
        index = run_index.RunIndex(held, width)
        asked = held + [bytes(pick.choice(b"abc\x00") for _ in range(pick.randint(0, 20))) for _ in range(6)]
        text, begins = run_index.joined(asked)
        length, rank = index.statistics(text, begins)
        for k, s in enumerate(asked):
            for i in range(len(s)):
                best = max(n for n in range(len(s) - i + 1) if any(s[i:i + n] in h for h in held))
                assert length[begins[k] + i] == best
                if best >= width:
                    place = next(index.begins[q] + h.index(s[i:i + width]) for q, h in enumerate(held) if s[i:i + width] in h)
                    assert index.earliest(rank[begins[k] + i:begins[k] + i + 1])[0] == place


def test_sketch_never_misses(spark):
    values = [k % 700 for k in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    as_hashes = lambda b: [suffixes.mix(b.column("v").to_numpy().astype(np.uint64))]
    for bits in (9, 16):
        bitmap = sketch.sketch(df, as_hashes, bits, 2)
        hit = sketch.passes(bitmap, suffixes.mix(np.arange(700, dtype=np.uint64)), bits)
        assert hit[:300].all()
        assert bits == 9 or hit[300:].mean() < 0.05
