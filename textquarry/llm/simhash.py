"""Near-duplicates by SimHash fingerprints, found by multi-index hashing.

The fingerprint's 64 bits are cut into three segments. Fingerprints that differ in at most ``distance`` bits differ in
at most a third of them in some segment, so each one enumerates the small Hamming ball around each of its segments
and fetches the fingerprints stored under those values; the complete distance decides. Only distinct fingerprints take
part. A segment value under which very many are stored is split on both sides into pieces that meet pairwise, and each
task returns a spanning forest of the links it finds instead of the links, so dense groups stay small.

Defined cases: a null text has no words and fingerprint zero; texts without words are linked like any others; a null id
counts as smaller than every other; ids may repeat; other columns fall away.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import doc_rows, stored
from textquarry.llm.components import components

SEGMENTS = ((0, 21), (21, 21), (42, 22))
PIECE = 4096
GROUP_ROWS = 100_000
PAIRS = 1 << 21
NULL_ID = -(1 << 63)


def fingerprint(text: bytes, shingle: int = 4, block: int = 1 << 16) -> int:
    """Bits set in over half of the XXH64 hashes (seed 42) of the word shingles of ``text``, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle, len(words))
    starts = np.append(0, ends[:-1] + 1)[:len(words) - size + 1].tolist()
    digest, ends = xxhash.xxh64_intdigest, ends[size - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(starts), block):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[lo:lo + block], ends[lo:lo + block])], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id, th (hash of the text) and fp, the fingerprint's 64 bits as a long."""

    def emit(batches):
        for batch in batches:
            fps = [fingerprint(text.as_py().encode(), shingle) for text in batch.column("text")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "th": batch.column("th"), "fp": pa.array(fps, pa.int64())})

    return doc_rows(docs).mapInArrow(emit, "doc_id long, th long, fp long")


def segment_rows(distinct: DataFrame, distance: int) -> DataFrame:
    """key (segment and value), fp, probe: where each fingerprint is stored and where it looks.

    Of two differing values the larger is looked up, by the fingerprint with the smaller one.
    """
    radius = distance // len(SEGMENTS)

    def emit(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            bits = fps.view(np.uint64)
            for number, (shift, width) in enumerate(SEGMENTS):
                value = (bits >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                base = np.uint64(number << 32)
                rows = [(fps, base | value, False), (fps, base | value, True)]
                for size in range(1, radius + 1):
                    for flip in combinations(range(width), size):
                        other = value ^ np.uint64(sum(1 << f for f in flip))
                        up = other > value
                        rows.append((fps[up], base | other[up], True))
                yield pa.record_batch({
                    "key": pa.array(np.concatenate([k for _, k, _ in rows]).view(np.int64)), "fp": pa.array(np.concatenate([f for f, _, _ in rows])),
                    "probe": pa.array(np.repeat([p for _, _, p in rows], [len(f) for f, _, _ in rows])),
                })

    return distinct.mapInArrow(emit, "key long, fp long, probe boolean")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, least node) with the same components as the edges a-b."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = place[:len(a)], place[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _links(distance):
    def verify(table):
        keys = [table.column(c).to_numpy() for c in ("key", "part", "fp")]
        probe = table.column("probe").to_numpy(zero_copy_only=False)
        mixed = (keys[0].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ keys[1].view(np.uint64)
        held, asked = np.flatnonzero(~probe), np.flatnonzero(probe)
        held = held[np.argsort(mixed[held])]
        lo, hi = (np.searchsorted(mixed[held], mixed[asked], side) for side in ("left", "right"))
        bounds = np.append(0, np.cumsum(hi - lo))
        a, b, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        while at < len(asked):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PAIRS, "right")) - 1)
            n = (hi - lo)[at:to]
            mine = np.repeat(asked[at:to], n)
            other = held[np.arange(bounds[to] - bounds[at]) + np.repeat(lo[at:to] - (bounds[at:to] - bounds[at]), n)]
            x, y = keys[2][mine], keys[2][other]
            near = (x != y) & (np.bitwise_count((x ^ y).view(np.uint64)) <= distance)
            a, b = forest(np.append(a, x[near]), np.append(b, y[near]))
            at = to
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return verify


def links(distinct: DataFrame, distance: int, piece: int = PIECE) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints within ``distance`` bits."""
    rows = segment_rows(distinct, distance)
    held = F.count_if(~F.col("probe"))
    pieces = lambda n: F.ceil(n / piece)
    hot = rows.groupBy("key").agg(pieces(held).alias("p"), pieces(F.count_if("probe")).alias("q")).where("p > 1 or (p = 1 and q > 1)")
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("probe"), F.col("q")).otherwise(F.col("p")))
    across = F.sequence(F.lit(0).cast("long"), F.when(F.col("probe"), F.col("p")).otherwise(F.col("q")) - 1)
    met = F.transform(across, lambda o: F.when(F.col("probe"), o * F.col("q") + own).otherwise(own * F.col("q") + o))
    dealt = rows.join(hot, "key", "left").select("key", "fp", "probe", F.explode(F.when(F.col("p").isNull(), F.array(F.lit(0).cast("long"))).otherwise(met)).alias("part"))
    groups = max(1, -(-distinct.count() * 36 // GROUP_ROWS))
    return dealt.withColumn("task", F.pmod(F.xxhash64("key", "part"), F.lit(groups))).groupBy("task").applyInArrow(_links(distance), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """Per row of ``docs``: doc_id, th, fp and component_id, the smallest id reachable over links."""
    marked = stored(fingerprints(docs, shingle).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID))))
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    stars = components(links(distinct.select("fp"), distance))
    rooted = distinct.join(stars, distinct["fp"] == stars["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(by_print, "fp").select(*(F.nullif(c, F.lit(NULL_ID)).alias(c) for c in ("doc_id", "component_id")), "th", "fp")


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
