"""Whitening of embeddings along their leading principal components, by Chebyshev-filtered subspace iteration.

A vector's entries become the integers x = floor(1024 c) + 100000, written once to be read by every pass. One aggregation
gives their number n and the sums S per dimension. The covariance V of x is never formed: each pass over the rows multiplies
it with a narrow block Q as the sum of Y'(YQ), Y being the rows less the mean; a partition returns one small block, and
blocks are added by a Spark aggregation. A round applies a Chebyshev polynomial of V to the block, pass by pass, which damps
the spectrum below the block's least Ritz value and lifts what lies above; QR and Rayleigh-Ritz follow, whose product V Q is
at once the next round's first. Rounds end when the residual of every wanted pair certifies it (|Vq - eq| <= TOLERANCE e1)
or no longer falls below ACCEPTED; more than MAX_ROUNDS rounds are an error, an uncertified basis is never returned.

Defined cases: rows whose vector is null, has null or non-finite entries, or whose length is not the commonest (of equally
common ones the greatest) or with an entry beyond 64 bits, fall away; no rows give no rows; a component of eigenvalue zero
(fewer distinct vectors or dimensions than components) is left out; repeated rows each count and each give their rows;
other columns fall away; a deviation beyond 64 bits is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import stored

#: Residual of a wanted pair, as a part of the greatest eigenvalue, at which it counts as exact.
TOLERANCE = 1e-13
#: A basis whose residuals stopped falling must at least have come here.
ACCEPTED = 1e-10
DEGREE, SPARE, MAX_ROUNDS = 10, 24, 60
SHIFT, SCALE = 100_000, 1024


def integer_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x (array of long) of the rows that stay."""
    entries = F.col(column).cast("array<double>")
    c = F.lit(float(1 << 62)) / SCALE
    usable = F.forall(entries, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < c)) & (F.size(entries) > 0)
    rows = embeddings.select(F.col("vec_id"), entries.alias("v")).where(F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", F.transform("v", lambda v: F.floor(v * SCALE) + SHIFT).alias("x"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sums per dimension."""

    def add(batches):
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            n, total = n + len(x), total + (x >> 32).sum(0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)
        yield pa.record_batch({"i": pa.array(range(-1, width), pa.int32()), "s": pa.array([str(v) for v in [n, *total]])})

    parts = rows.select("x").mapInArrow(add, "i int, s string")
    held = {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return held.get(-1, 0), np.array([held.get(i, 0) for i in range(width)], object)


def _added(rows: DataFrame, partial, height: int, width: int) -> np.ndarray:
    """The sum over all batches of ``partial(x)`` (height x width), added within partitions first."""

    def add(batches):
        total = np.zeros((height, width))
        for batch in batches:
            if batch.num_rows:
                total += partial(batch.column("x"))
        yield pa.record_batch({"i": pa.array(range(height), pa.int32()), "v": pa.ListArray.from_arrays(np.arange(height + 1, dtype=np.int32) * width, total.ravel())})

    parts = rows.select("x").mapInArrow(add, "i int, v array<double>")
    summed = parts.groupBy("i").agg(F.array(*(F.sum(F.col("v")[j]) for j in range(width))).alias("v")).collect()
    out = np.zeros((height, width))
    for r in summed:
        out[r.i] = r.v
    return out


class Basis:
    """n, exact sums, mean, and unit eigenvectors (columns) with their eigenvalues, falling; trace of the covariance."""

    def __init__(self, n, sums, vectors, values, trace, passes, residual):
        self.n, self.sums, self.vectors, self.values, self.trace, self.passes, self.residual = n, sums, vectors, values, trace, passes, residual
        self.mean = _mean(n, sums)


def _mean(n: int, sums: np.ndarray) -> np.ndarray:
    return np.array([s // n + (s % n) / n for s in sums], float)


def principal_components(rows: DataFrame, wanted: int = 8, degree: int = DEGREE, spare: int = SPARE) -> Basis | None:
    """The ``wanted`` leading components of ``x`` in ``rows`` (arrays of one length); None without rows."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first.d
    n, sums = _sums(rows, d)
    mean, passes = _mean(n, sums), 0
    k = min(d, wanted + spare)

    def times(q: np.ndarray) -> np.ndarray:
        """V q, by one pass over the rows."""
        nonlocal passes
        passes += 1

        def partial(x):
            y = _matrix(x, d) - mean
            return y.T @ (y @ q)

        return _added(rows, partial, d, q.shape[1]) / n

    def spread(x):
        y = _matrix(x, d) - mean
        return (y * y).sum(0)[:, None]

    trace = float(_added(rows, spread, d, 1).sum() / n)
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((d, k)))[0]
    vq, best = times(q), np.inf
    for _ in range(MAX_ROUNDS):
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = np.maximum(values[::-1], 0.0), turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = min(wanted, k)
        residual = np.linalg.norm(vq[:, :top] - q[:, :top] * values[:top], axis=0).max()
        if residual <= TOLERANCE * values[0] or k == d or (residual <= ACCEPTED * values[0] and residual > best / 4):
            return Basis(n, sums, q[:, :top], values[:top], trace, passes, residual)
        best = min(best, residual)
        cut = max(values[-1], 1e-14 * values[0])
        half, sigma = cut / 2, (cut / 2) / (values[0] - cut / 2)
        before, now, s = q, (vq - half * q) * (sigma / half), sigma
        for _ in range(degree - 1):
            ahead = 1 / (2 / sigma - s)
            before, now, s = now, 2 * (times(now) - half * now) * (ahead / half) - s * ahead * before, ahead
        q = np.linalg.qr(now / np.linalg.norm(now, axis=0))[0]
        vq = times(q)
    raise ArithmeticError(f"residual {best} after {MAX_ROUNDS} rounds: the wanted eigenvalues do not stand apart")


def whiten(embeddings: DataFrame, column: str = "embedding", wanted: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each remaining row and component."""
    rows = stored(integer_vectors(embeddings, column))
    vec_id = dict(embeddings.dtypes)["vec_id"]
    schema = f"vec_id {vec_id}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return embeddings.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("x") == lengths[0].d)
    basis = principal_components(rows, wanted)
    n, d, sums, mean = basis.n, lengths[0].d, basis.sums, basis.mean
    real = basis.values > 1e-12 * max(basis.values[0], 1e-300)
    if basis.values[0] <= 0:
        real[:] = False
    scaled = basis.vectors[:, real] / np.sqrt(basis.values[real])
    explained, k = basis.values[real] / basis.trace if basis.trace else basis.values[real], int(real.sum())
    if not k:
        return embeddings.sparkSession.createDataFrame([], schema)

    def moments(x):
        w = (_matrix(x, d) - mean) @ scaled
        return np.vstack((w.T @ w, w.sum(0)))

    summed = _added(rows, moments, k + 1, k) / n
    error = float(np.abs(summed[:k] - np.outer(summed[k], summed[k]) - np.eye(k)).max())

    def emit(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            w = (x - mean) @ scaled
            take = np.repeat(np.arange(len(x)), k)
            yield pa.record_batch({
                "vec_id": batch.column("vec_id").take(pa.array(take)), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(take), n)), "deviation": pa.array(_deviations(x, n, sums)[take]), "whitened": pa.array(w.ravel()),
                "explained": pa.array(np.tile(explained, len(x))), "identity_error": pa.array(np.full(len(take), error)),
            })

    return rows.mapInArrow(emit, schema)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2, exact: in 64 bits where these hold it, else in Python's integers."""
    far = max([abs(n * int(x.max(initial=0))), abs(n * int(x.min(initial=0))), *(abs(int(s)) for s in sums)])
    if far < 1 << 61:
        apart = x * np.int64(n) - sums.astype(np.int64)
        if float(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] < 2.0 ** 62:
            return (apart * apart).sum(1)
    exact = [(sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))) for row in x.tolist()]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation does not fit 64 bits")
    return np.array(exact, np.int64)


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
