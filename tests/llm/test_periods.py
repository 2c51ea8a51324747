"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from textquarry.llm import periods

from .rows import awkward, empty, frame

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """All (start, length, period), by comparing the words with themselves at each distance."""
    table, found = {}, {}
    numbers = np.array([table.setdefault(w, len(table)) for w in words], int)
    for q in range(1, len(words) // 3 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], numbers[:-q] == numbers[q:], [0]))))
        for i, j in edges.reshape(-1, 2).tolist():
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return (text or "").encode().split()


def plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def brute_row(doc_id, text):
    words = [w.decode() for w in plant(doc_id, split(text))]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(collapsed(words, found)))


def sequences():
    pick = random.Random(9)
    few = lambda n, k: [pick.randrange(k) for _ in range(n)]
    out = [[], [1], few(23, 1), few(24, 1), few(25, 1), few(1000, 1), few(400, 2), few(300, 3)]
    for q in [1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100, 200]:
        for times in (2.9, 3, 3.5, 6):
            base, n = few(q, 50), int(q * times)
            out.append(few(pick.randrange(40), 50) + (base * 7)[:n] + few(pick.randrange(40), 50))
    for _ in range(30):
        inner = (few(pick.randrange(1, 4), 3) * 30)[:pick.randrange(20, 60)]
        out.append(few(5, 9) + (inner + few(pick.randrange(1, 6), 9)) * pick.randrange(2, 6) + few(3, 9))
    word = [0]
    for _ in range(11):
        word += [1 - w for w in word]
    out += [word, ([0] * 200 + [1]) * 9, ([0] * 40 + [1] + [0] * 40 + [2]) * 7]
    a, b = [0], [0, 1]
    while len(b) < 2500:
        a, b = b, b + a
    return out + [b]


@pytest.mark.parametrize("batch,longest", [(1 << 20, 1 << 17), (64, 16)])
def test_runs_against_every_period(monkeypatch, batch, longest):
    monkeypatch.setattr(periods, "BATCH", batch)
    monkeypatch.setattr(periods, "LONGEST", longest)
    held = [[f"w{v}".encode() for v in s] for s in sequences()]
    got = list(periods.text_runs([b" ".join(words) for words in held]))
    for words, (n, found, text) in zip(held, got, strict=True):
        want = brute_runs(words)
        assert n == len(words) and [tuple(map(int, r)) for r in found] == want
        assert text == collapsed([w.decode() for w in words], want).encode()


@pytest.mark.parametrize("size", [2, 32, 64, 128, 4096, 16384])
def test_transform_and_its_inverse(size):
    draw = np.random.default_rng(size)
    x = draw.integers(0, periods.PRIME, (3, size)).astype(float)
    there = periods.transform(x.copy())
    back = periods._mod(periods.transform(there, True) * float(pow(size, -1, periods.PRIME)))
    assert (back == x).all()
    root = pow(periods.ROOT, (periods.PRIME - 1) // size, periods.PRIME)
    for k in (0, 1, size - 1):
        assert int(there[1, k]) == sum(int(v) * pow(root, i * k, periods.PRIME) for i, v in enumerate(x[1])) % periods.PRIME


def test_occurrences_are_found_by_their_zero_sums():
    draw = np.random.default_rng(1)
    numbers = draw.integers(0, 2, 500)
    residues = numbers.astype(float)
    squares = np.append(0, np.cumsum(numbers * numbers))
    blocks = np.arange(0, 480, 8)
    place, distance = periods.occurrences(residues, squares, blocks, 8, 1, 15)
    want = {(b, d) for b in blocks for d in range(1, 16) if b + d + 8 <= 500 and (numbers[b:b + 8] == numbers[b + d:b + d + 8]).all()}
    assert {(int(b), int(d)) for b, d in zip(place, distance) if b + d + 8 <= 500} == want


def test_equal_hashes_are_drawn_anew(monkeypatch):
    """A hash that calls everything equal once is found out by the comparison of words."""
    real, calls = periods.Stretches.equal, []

    def once(self, a, b, size):
        calls.append(1)
        return np.ones(len(a), bool) if len(calls) < 9 else real(self, a, b, size)

    monkeypatch.setattr(periods.Stretches, "equal", once)
    words = [b"x", b"y"] * 40 + [b"z%d" % k for k in range(50)]
    assert [tuple(map(int, r)) for r in next(iter(periods.text_runs([b" ".join(words)])))[1]] == [(0, 80, 2)]


def test_rows(spark):
    pick = random.Random(3)
    rows = awkward(21) + [(200 + k, " ".join((pick.choices("abcdefg", k=pick.randrange(1, 30)) * 9)[:pick.randrange(20, 200)])) for k in range(40)]
    rows += [(300, "na " * 20_000), (301, "ü\x0bü\x0cü " * 30), (302, "a b " * 30)]
    got = periods.periodic_runs(frame(spark, rows)).collect()
    want = sorted(((i, len(w := [x.decode() for x in split(t)]), f := brute_runs(w), collapsed(w, f)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == want
    assert periods.periodic_runs(empty(spark)).count() == 0


def test_query(spark, tmp_path):
    rows = awkward(22) + [(400 + k, " ".join(f"w{(k * j) % 97}" for j in range(k * 3))) for k in range(90)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = periods.query(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute_row(i, t) for i, t in rows), key=repr)
    given = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(map(tuple, periods.query(spark, SF).collect())) == sorted(brute_row(r.doc_id, r.text) for r in given)
