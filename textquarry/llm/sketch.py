"""Count-min sketches of 64-bit hashes: built per partition, merged by adding counters, kept as one bit per cell."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

DEPTH = 2
PARTS = 64
LANES = 32


def _cells(hashes: np.ndarray, bits: int, row: int) -> np.ndarray:
    return (hashes >> np.uint64(32 * row)) & np.uint64((1 << bits) - 1)


def _sparse(part: int, lane: int, cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    gaps = np.diff(cells.astype(np.uint32), prepend=np.uint32(0))
    return pa.record_batch({
        "part": pa.array([part], pa.int32()), "lane": pa.array([lane], pa.int32()), "size": pa.array([len(cells)], pa.int32()),
        "gaps": pa.array([pa.compress(gaps.tobytes(), codec="zstd", asbytes=True)]), "counts": pa.array([pa.compress(counts.tobytes(), codec="zstd", asbytes=True)]),
    })


def _added(batches: Iterator[pa.RecordBatch], span: int, most: int) -> np.ndarray:
    """Counters of a part, added up as the batches stream in."""
    total = np.zeros(span, np.uint8)
    for batch in batches:
        for size, gaps, counts in zip(*(batch.column(c).to_pylist() for c in ("size", "gaps", "counts"))):
            cells = np.cumsum(np.frombuffer(pa.decompress(gaps, size * 4, codec="zstd"), np.uint32))
            total[cells] = np.minimum(total[cells] + np.frombuffer(pa.decompress(counts, size, codec="zstd"), np.uint8), most)
    return total


def sketch(df: DataFrame, hashes_of, bits: int, at_least: int) -> np.ndarray:
    """Bits of the cells counted ``at_least`` times over all hashes that ``hashes_of`` yields from the batches of ``df``.

    Counters stop at ``at_least``, so 2 * 2**bits small counters are all a sketch ever holds; the result has as many
    bits. A cell counts every hash that falls on it: no hash seen ``at_least`` times is missed, some others pass.
    """
    span = (1 << bits) // PARTS

    def count(batches):
        hashes = [np.zeros(0, np.uint64)]
        for batch in batches:
            hashes += hashes_of(batch)
        hashes, lane = np.concatenate(hashes), TaskContext.get().partitionId() % LANES
        for row in range(DEPTH):
            cells, counts = np.unique(_cells(hashes, bits, row), return_counts=True)
            cut = np.searchsorted(cells, np.arange(PARTS + 1, dtype=np.uint64) * np.uint64(span))
            for part in np.flatnonzero(np.diff(cut)):
                own = slice(cut[part], cut[part + 1])
                yield _sparse(row * PARTS + int(part), lane, cells[own] - np.uint64(int(part) * span), np.minimum(counts[own], at_least).astype(np.uint8))

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _added(batches, span, at_least)
        cells = np.flatnonzero(total)
        yield _sparse(key[0].as_py(), key[1].as_py(), cells, total[cells])

    def finish(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.packbits(_added(batches, span, at_least) >= at_least)
        yield pa.record_batch({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([packed.tobytes()])})

    schema = "part int, lane int, size int, gaps binary, counts binary"
    partial = df.mapInArrow(count, schema).groupBy("part", "lane").applyInArrow(merge, schema)
    merged = np.zeros((DEPTH * PARTS, span // 8), np.uint8)
    for part, packed in partial.groupBy("part").applyInArrow(finish, "part int, bits binary").toLocalIterator():
        merged[part] = np.frombuffer(packed, np.uint8)
    return merged.reshape(DEPTH, -1)


def passes(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether each hash may have reached the count of the sketch."""
    hit = np.ones(len(hashes), bool)
    for row in range(DEPTH):
        cell = _cells(hashes, bits, row)
        hit &= (bitmap[row][cell >> np.uint64(3)] >> (np.uint64(7) - (cell & np.uint64(7)))) & np.uint64(1) == 1
    return hit
