"""Whitening against a dense eigensolver."""

import math

import numpy as np
from pyspark.sql import functions as F

from textquarry.llm import whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, i int, component string"


def brute(rows, wanted=8):
    """(vec_id, n, deviation, |whitened|) by component, eigenvalues and trace, from a dense covariance."""
    held = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(held), np.array([v for _, v in held], float)
    sums = [sum(v[j] for _, v in held) for j in range(x.shape[1])]
    y = x - np.array(sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for _, v in held]
    return [i for i, _ in held], n, deviation, y @ vectors / np.sqrt(values), values / np.trace(y.T @ y / n)


def check(got, rows, wanted=8):
    ids, n, deviation, white, explained = brute(rows, wanted)
    assert len(got) == len(ids) * white.shape[1]
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    for k in range(white.shape[1]):
        held = sorted(by[k + 1], key=lambda r: (r.vec_id is None, r.vec_id or 0, r.deviation, abs(r.whitened)))
        order = sorted(range(len(ids)), key=lambda j: (ids[j] is None, ids[j] or 0, deviation[j], abs(white[j, k])))
        assert [r.vec_id for r in held] == [ids[j] for j in order]
        assert [r.deviation for r in held] == [deviation[j] for j in order] and {r.n for r in held} == {n}
        mine, other = np.array([r.whitened for r in held]), white[order, k]
        assert min(np.abs(mine - other).max(), np.abs(mine + other).max()) < 1e-7
        assert abs(held[0].explained / explained[k] - 1) < 1e-9
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-8


def test_given_vectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    check(whitening.query(spark, SF).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_awkward_rows(spark):
    draw = np.random.default_rng(4)
    base = draw.standard_normal((12, 40)) * np.linspace(3, 0.5, 12)[:, None]
    rows = [(k, [float(np.float32(v)) for v in draw.standard_normal(12) @ base + 0.1 * draw.standard_normal(40)]) for k in range(300)]
    rows += [rows[5]] * 150 + [(None, rows[7][1]), (7, rows[8][1])]
    bad = [(900, None), (901, []), (902, [None] * 40), (903, [float("nan")] * 40), (904, [float("inf")] + [0.0] * 39), (905, [1.0] * 39), (906, [float(1e30)] * 40)]
    table = spark.createDataFrame([(i, v, 1, "x", 2, "c") for i, v in rows + bad], SCHEMA).repartition(5)
    check(whitening.whiten(table).collect(), rows)


def test_few_dimensions_and_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(k, [float(np.float32(v)) for v in draw.standard_normal(3)]) for k in range(50)]
    check(whitening.whiten(spark.createDataFrame([(*r, 1, "x", 2, "c") for r in rows], SCHEMA)).collect(), rows, 3)
    same = spark.createDataFrame([(k, [0.5, 0.25], 1, "x", 2, "c") for k in range(5)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.5], 1, "x", 2, "c") for k in range(6)], SCHEMA)
    assert sorted({r.component for r in whitening.whiten(line).collect()}) == [1]
    assert whitening.whiten(same.where(F.lit(False))).collect() == []


def test_close_eigenvalues_are_told_apart(spark):
    """A spectrum that falls slowly past the wanted components: certified residuals, fewer passes than dimensions squared."""
    draw = np.random.default_rng(6)
    turn = np.linalg.qr(draw.standard_normal((64, 64)))[0]
    scale = 1 + np.append(np.linspace(2, 1.2, 8), np.linspace(1, 0, 56))
    x = (draw.standard_normal((4000, 64)) * scale) @ turn
    table = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<float>")
    basis = whitening.principal_components(whitening.integer_vectors(table))
    assert basis.residual <= whitening.ACCEPTED * basis.values[0]
    check(whitening.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_deviations_beyond_64_bits():
    x, sums = np.array([[1 << 40, 5], [3, 4]]), np.array([(1 << 40) + 3, 9], object)
    assert whitening._deviations(np.array([[7, 5], [3, 4]]), 2, np.array([10, 9], object)).tolist() == [17, 17]
    try:
        whitening._deviations(x, 2, sums)
    except OverflowError:
        return
    raise AssertionError("no error")
