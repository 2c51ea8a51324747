"""Exact deduplication: counting quotient filters per partition, merged, then a comparison of the bytes.

A text (A-Z lower-cased) gets a 64-bit fingerprint: quotient above, remainder below. A partition's filter holds, per
quotient in order, its sorted remainders with counts; filters merge without loss, quotient range by quotient range, by
merging sorted remainders and adding counts. Texts whose fingerprint counts more than one are grouped by their whole
bytes; all others are unique.

Defined cases: a null text counts as empty; a null id counts as smaller than every other; rows that share text and id
are all counted and get equal rows (all kept if that id is the largest); other columns fall away.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import doc_rows, stored
from textquarry.llm.sketch import passes, sketch

REMAINDER = 32
RANGE_ROWS = 1 << 20
BITS = 26


def _filter(low: int, prints: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """The filter of sorted distinct fingerprints: quotients as gaps with their run lengths, remainders, counts."""
    quotient, run = np.unique(prints >> np.uint64(REMAINDER), return_counts=True)
    parts = {
        "gaps": np.diff(quotient.astype(np.uint32), prepend=np.uint32(0)), "runs": run.astype(np.uint32),
        "remainders": (prints & np.uint64((1 << REMAINDER) - 1)).astype(np.uint32), "counts": counts.astype(np.uint32),
    }
    return pa.record_batch({"range": pa.array([low], pa.int64())} | {k: pa.array([v.tobytes()]) for k, v in parts.items()})


def _entries(gaps, runs, remainders, counts):
    gaps, runs, remainders, counts = (np.frombuffer(x, np.uint32) for x in (gaps, runs, remainders, counts))
    quotient = np.repeat(np.cumsum(gaps, dtype=np.uint32).astype(np.uint64), runs)
    return (quotient << np.uint64(REMAINDER)) | remainders.astype(np.uint64), counts.astype(np.int64)


def repeated_prints(texts: DataFrame, ranges: int) -> DataFrame:
    """``fp``: fingerprints counted more than once in the merge of all partitions' filters."""
    width = -(-(1 << 32) // ranges)

    def build(batches):
        prints = [np.zeros(0, np.uint64)]
        for batch in batches:
            prints.append(np.array([xxhash.xxh3_64_intdigest(t.as_py().encode().lower()) for t in batch.column("text")], np.uint64))
        prints, counts = np.unique(np.concatenate(prints), return_counts=True)
        low = ((prints >> np.uint64(REMAINDER)) // np.uint64(width)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.diff(low, prepend=-1)), len(low))
        for a, b in zip(cuts, cuts[1:]):
            yield _filter(int(low[a]), prints[a:b], counts[a:b])

    def merge(table):
        filters = [_entries(*x) for x in zip(*(table.column(c).to_pylist() for c in ("gaps", "runs", "remainders", "counts")))]
        prints, place = np.unique(np.concatenate([p for p, _ in filters]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in filters]))
        return pa.table({"fp": pa.array(prints[counts > 1].view(np.int64))})

    filters = texts.mapInArrow(build, "range long, gaps binary, runs binary, remainders binary, counts binary")
    return filters.groupBy("range").applyInArrow(merge, "fp long")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id (largest id among equal texts), group_size, kept, text_sha256."""
    rows = doc_rows(docs)
    repeated = stored(repeated_prints(rows.select("text"), max(1, -(-rows.count() // RANGE_ROWS))))
    marks = sketch(repeated, lambda batch: [batch.column("fp").to_numpy().view(np.uint64)], BITS, 1)
    marks = rows.sparkSession.sparkContext.broadcast(marks)

    def normal(batches):
        for batch in batches:
            texts = [t.as_py().encode().lower() for t in batch.column("text")]
            prints = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)
            may = passes(marks.value, prints, BITS)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "fp": pa.array(prints.view(np.int64)), "sha": pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                "bytes": pa.array([t if m else None for t, m in zip(texts, may)], pa.binary()),
            })

    hashed = rows.mapInArrow(normal, "doc_id long, fp long, sha binary, bytes binary")
    routed = hashed.where(F.col("bytes").isNotNull()).join(repeated, "fp", "left_semi")
    groups = (
        routed.groupBy("fp", "bytes").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.first("sha").alias("sha"))
        .where("group_size > 1").select("fp", "sha", "keep_id", "group_size")
    )
    joined = hashed.drop("bytes").join(groups, ["fp", "sha"], "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
