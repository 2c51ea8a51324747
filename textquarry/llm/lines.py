"""Line deduplication by pairwise alignment of overlapping documents.

A line (trimmed; blank lines count for nothing) links every document that holds it with the first one that does. Linked
documents are aligned by patience diff, and the later one loses its lines in the aligned common blocks. So every document
is aligned with the first holder of each of its lines, however many hold it: the pairs number at most one per line, and
no group is paired with itself. A caller who gives ``rare`` aligns only pairs that share a line held by at most so many
documents or several lines (``several``, or all that the later one has); the query and the pipeline do not. A caller who
gives ``whole`` keeps each document whole that has at least this part of its characters (blanks at line ends left out) in
blocks aligned with one earlier document: such a near copy is not torn into remnants but left to a stage that judges
documents as wholes. The pipeline gives it, the query does not.

Defined cases: a null text has no lines; documents are ordered by id (null first), then by a hash of the text; equal
rows count as one document and get equal rows; a document may end up with an empty text; other columns stay.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.common import doc_rows, stored

NULL_ID = -(1 << 63)


def _anchors(a: list, b: list, lo: int, hi: int, from_: int, to: int) -> list[tuple[int, int]]:
    """Lines that stand once in each stretch, as the longest chain in the order of both."""

    def once(seq, start, end):
        at, twice = {}, set()
        for i in range(start, end):
            if seq[i] in at:
                twice.add(seq[i])
            at[seq[i]] = i
        return {k: i for k, i in at.items() if k not in twice}

    other = once(b, from_, to)
    pairs = [(i, other[k]) for k, i in once(a, lo, hi).items() if k in other]
    pairs.sort()
    tails, ends, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        tails[k:k + 1], ends[k:k + 1] = [j], [n]
        back.append(ends[k - 1] if k else -1)
    chain, n = [], ends[-1] if ends else -1
    while n >= 0:
        chain.append(pairs[n])
        n = back[n]
    return chain[::-1]


def aligned(a: list, b: list) -> list[int]:
    """Positions of ``a`` whose lines patience diff aligns with lines of ``b``."""
    found, open_ = [], [(0, len(a), 0, len(b))]
    while open_:
        lo, hi, from_, to = open_.pop()
        while lo < hi and from_ < to and a[lo] == b[from_]:
            found.append(lo)
            lo, from_ = lo + 1, from_ + 1
        while lo < hi and from_ < to and a[hi - 1] == b[to - 1]:
            hi, to = hi - 1, to - 1
            found.append(hi)
        if lo < hi and from_ < to:
            chain = _anchors(a, b, lo, hi, from_, to)
            for i, j in chain:
                open_.append((lo, i, from_, j))
                lo, from_ = i, j
            if chain:
                open_.append((lo, hi, from_, to))
    return found


def _sequences(column: pa.ListArray):
    """The lists of a column one by one: a first holder's sequence stands in very many rows of a batch."""
    values, bounds = column.values.to_numpy(), column.offsets.to_numpy()
    return (values[a:b].tolist() for a, b in zip(bounds, bounds[1:]))


def overlapping(lines: DataFrame, rare: int | None, several: int) -> DataFrame:
    """Pairs (doc_id, th) and first (doc_id, th of the earlier document) that overlap. ``lines`` has their ``keys``."""
    own = F.size("keys").alias("own")
    single = lines.select("doc_id", "th", own, F.explode("keys").alias("key"))
    holders = stored(single.groupBy("key").agg(F.count("*").alias("held"), F.min(F.struct("doc_id", "th")).alias("first")).where("held > 1"))
    shared = single.join(holders, "key").where(F.struct("doc_id", "th") > F.col("first"))
    pairs = shared.groupBy("doc_id", "th", "first").agg(F.count("*").alias("shared"), F.min("held").alias("rarest"), F.any_value("own").alias("own"))
    if rare is not None:
        pairs = pairs.where((F.col("rarest") <= rare) | (F.col("shared") >= F.least(F.lit(several), F.col("own"))))
    return pairs.select("doc_id", "th", F.col("first.doc_id").alias("first_id"), F.col("first.th").alias("first_th"))


def repeated_lines(rows: DataFrame, rare: int | None = None, several: int = 3, whole: float | None = None) -> DataFrame:
    """doc_id, th, partners (documents aligned with) and gone (positions of the lines to delete)."""
    split = F.split("text", "\n")
    digest = lambda line, seed: F.xxhash64(F.lit(seed), F.trim(line))
    keys = F.array_compact(F.array_distinct(F.transform(split, lambda line: F.when(F.trim(line) != "", digest(line, 1)))))
    sizes = [] if whole is None else [F.transform(split, lambda line: F.length(F.trim(line))).alias("sizes")]
    lines = stored(rows.select("doc_id", "th", keys.alias("keys"), F.transform(split, lambda line: digest(line, 2)).alias("seq"), *sizes).dropDuplicates(["doc_id", "th"]))
    first = lines.select(F.col("doc_id").alias("first_id"), F.col("th").alias("first_th"), F.col("seq").alias("first_seq"))
    own = [c for c in ("seq", "sizes") if c in lines.columns]
    pairs = overlapping(lines, rare, several).join(lines.select("doc_id", "th", *own), ["doc_id", "th"]).join(first, ["first_id", "first_th"])

    def align(batches):
        for batch in batches:
            found = [aligned(a, b) for a, b in zip(_sequences(batch.column("seq")), _sequences(batch.column("first_seq")))]
            copy = np.zeros(len(found), bool)
            if whole is not None:
                copy[:] = [sum(s[i] for i in at) >= whole * sum(s) for at, s in zip(found, _sequences(batch.column("sizes")))]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "th": batch.column("th"), "found": pa.array(found, pa.list_(pa.int64())), "copy": pa.array(copy)})

    matched = pairs.select("doc_id", "th", *own, "first_seq").mapInArrow(align, "doc_id long, th long, found array<long>, copy boolean")
    gone = F.array_distinct(F.flatten(F.collect_list("found")))
    per_row = matched.groupBy("doc_id", "th").agg(F.count("*").alias("partners"), gone.alias("gone"), F.bool_or("copy").alias("copy"))
    return per_row.select("doc_id", "th", "partners", F.when(~F.col("copy"), F.col("gone")).alias("gone"))


def dedup_lines(docs: DataFrame, rare: int | None = None, several: int = 3, whole: float | None = None) -> DataFrame:
    """``docs`` with the lines left in ``text``, and n_lines, n_deleted, n_partners beside its columns."""
    docs = docs.drop("n_lines", "n_deleted", "n_partners", "gone", "partners", "th_", "id_")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    id_ = F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID))
    rows = doc_rows(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    gone = repeated_lines(rows, rare, several, whole).withColumnsRenamed({"doc_id": "id_", "th": "th_"})
    marked = docs.withColumns({"id_": id_, "th_": F.xxhash64(text)}).join(gone, ["id_", "th_"], "left").drop("id_", "th_")
    schema = marked.drop("gone", "partners").schema
    out = T.StructType(schema.fields + [T.StructField(c, T.LongType()) for c in ("n_lines", "n_deleted", "n_partners")])

    def cut(batches):
        for batch in batches:
            texts, counts, deleted = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist()):
                held = (text or "").split("\n")
                keep = np.ones(len(held), bool)
                keep[np.asarray(gone or (), np.int64)] = False
                texts.append(text if not gone else "\n".join(line for line, k in zip(held, keep) if k))
                counts.append(len(held) if text else 0)
                deleted.append(int((~keep).sum()))
            kept = {n: batch.column(n) if n != "text" else pa.array(texts, pa.string()) for n in schema.names}
            partners = batch.column("partners").fill_null(0)
            yield pa.record_batch(kept | {"n_lines": pa.array(counts, pa.int64()), "n_deleted": pa.array(deleted, pa.int64()), "n_partners": partners})

    return marked.mapInArrow(cut, out)


def query(spark, sf_dir: str) -> DataFrame:
    kept = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_deleted", "n_partners", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
