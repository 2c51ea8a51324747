"""Removal of byte strings that already occur earlier in the corpus, by run-length indexes (suffix-array dedup).

Every ``size``-byte string is filed under the least of its byte grams, so that equal strings meet. Neighbouring strings
with one gram form a run of text (at most about 170 bytes). Runs whose gram may occur twice are grouped: equal runs
keep their earliest place, and the distinct runs that share a gram are dealt by gram into blocks of bounded size. Each
block becomes a run-compressed Burrows-Wheeler index with samples at its run ends; the runs of its gram stream their
matching statistics against it, and each match of ``size`` bytes or more whose earliest place lies before its own is
marked. Grams with very many distinct runs are grouped string by string instead, so no group outgrows a task.

Defined cases: a null text has no bytes; a text shorter than ``size`` stays whole; a null id counts as smaller than
every other; rows that share an id are ordered by a hash of their texts; equal rows count as one and get equal rows;
other columns fall away. Texts are handled whole (working memory of a task: about 60 times its longest text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrays import Rolling, mix, text_chunks, window_runs
from textquarry.llm.common import doc_rows, stored
from textquarry.llm.run_index import RunIndex, joined
from textquarry.llm.sketch import passes, sketch

GRAM = 32
BITS = 26
BLOCK_BYTES = 1 << 19
HOT_RUNS = 20_000
NULL_ID = -(1 << 63)


def _runs(data, offsets, size):
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    rolling = Rolling(data.astype(np.uint64) + np.uint64(1))
    return rolling, owner, *window_runs(rolling, owner, size, min(GRAM, size))


def _candidates(batch, size, bitmap, bits):
    """Runs whose gram may repeat, chunk by chunk."""
    for lo, hi, data, offsets in text_chunks(batch, "text"):
        rolling, owner, first, count, gram = _runs(data, offsets, size)
        hit = passes(bitmap, gram, bits)
        first, count, gram = first[hit], count[hit], gram[hit]
        yield lo, hi, data, offsets, owner[first], first, count, gram, rolling.stretch(first, first + count + size - 1)


def _place(doc_id, th, start):
    return mix(mix(doc_id.view(np.uint64)) ^ th.view(np.uint64) ^ mix(start.astype(np.uint64)))


def distinct_runs(rows: DataFrame, bitmap, size: int, bits: int) -> DataFrame:
    """The candidate runs without repetition, each with its earliest place."""

    def emit(batches):
        for batch in batches:
            for lo, hi, _, offsets, doc, first, count, gram, run in _candidates(batch, size, bitmap.value, bits):
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)), "th": batch.column("th").slice(lo, hi - lo).take(pa.array(doc)),
                    "start": pa.array((first - offsets[doc]).astype(np.int64)), "n": pa.array(count.astype(np.int64)),
                    "gram": pa.array(gram.view(np.int64)), "run": pa.array(run.view(np.int64)),
                })

    runs = rows.mapInArrow(emit, "doc_id long, th long, start long, n long, gram long, run long")
    return runs.groupBy("gram", "run", "n").agg(F.min(F.struct("doc_id", "th", "start")).alias("at")).select("gram", "run", "n", "at.*")


def run_texts(rows: DataFrame, bitmap, wanted: DataFrame, size: int, bits: int) -> DataFrame:
    """``wanted`` runs with their bytes, cut from the texts in a scan that a sketch of the wanted places narrows."""

    def places(batch):
        return [_place(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th", "start")))]

    marks = rows.sparkSession.sparkContext.broadcast(sketch(wanted.select("doc_id", "th", "start"), places, bits, 1))

    def emit(batches):
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
            for lo, _, data, offsets, doc, first, count, gram, run in _candidates(batch, size, bitmap.value, bits):
                own = np.flatnonzero(passes(marks.value, _place(ids[lo + doc], hashes[lo + doc], first - offsets[doc]), bits))
                first, count, doc = first[own], count[own], doc[own]
                yield pa.record_batch({
                    "doc_id": pa.array(ids[lo + doc]), "th": pa.array(hashes[lo + doc]), "start": pa.array((first - offsets[doc]).astype(np.int64)),
                    "gram": pa.array(gram[own].view(np.int64)), "run": pa.array(run[own].view(np.int64)),
                    "bytes": pa.array([data[a:b].tobytes() for a, b in zip(first.tolist(), (first + count + size - 1).tolist())], pa.binary()),
                })

    found = rows.mapInArrow(emit, "doc_id long, th long, start long, gram long, run long, bytes binary")
    return found.dropDuplicates(["gram", "run", "doc_id", "th", "start"])


def _repeats_in_block(size, block_bytes):
    def mark(table):
        order = table.sort_by([("doc_id", "ascending"), ("th", "ascending"), ("start", "ascending")])
        strings, out = order.column("bytes").to_pylist(), []
        ends = np.cumsum([len(s) for s in strings])
        cuts = [0, *np.searchsorted(ends, np.arange(4 * block_bytes, ends[-1], 4 * block_bytes)).tolist(), len(strings)]
        cuts = sorted(set(cuts))
        gone = [np.zeros(0, np.int64)] * len(strings)
        for lo, hi in zip(cuts, cuts[1:]):
            index = RunIndex(strings[lo:hi], size)
            for a, b in zip(cuts, cuts[1:]):
                if a < lo:
                    continue
                text, begins = (index.text, index.begins) if a == lo else joined(strings[a:b])
                length, rank = index.statistics(text, begins)
                long = np.flatnonzero(length >= size)
                if a == lo:
                    long = long[index.earliest(rank[long]) < long]
                own = np.searchsorted(begins, long, "right") - 1
                for k in np.unique(own):
                    gone[a + k] = np.union1d(gone[a + k], long[own == k] - begins[k]) if len(gone[a + k]) else long[own == k] - begins[k]
        for k, at in enumerate(gone):
            if len(at):
                out.append((k, at))
        rows = pa.array([k for k, _ in out], pa.int64())
        return pa.table({"gram": order.column("gram").take(rows), "run": order.column("run").take(rows), "gone": pa.array([a.tolist() for _, a in out], pa.list_(pa.int64()))})

    return mark


def _single_strings(size):
    """Each string of a run with two digests, for grams with too many runs for one block."""

    def emit(batches):
        for batch in batches:
            for gram, run, doc_id, th, start, text in zip(*(batch.column(c).to_pylist() for c in ("gram", "run", "doc_id", "th", "start", "bytes"))):
                symbols = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
                a, b = Rolling(symbols).every(size).view(np.int64), Rolling(mix(symbols)).every(size).view(np.int64)
                n = len(a)
                yield pa.record_batch({"gram": pa.array([gram] * n, pa.int64()), "run": pa.array([run] * n, pa.int64()), "doc_id": pa.array([doc_id] * n, pa.int64()), "th": pa.array([th] * n, pa.int64()),
                                       "start": pa.array(start + np.arange(n)), "at": pa.array(np.arange(n)), "a": pa.array(a), "b": pa.array(b)})

    return emit


def repeats_inside(texts: DataFrame, size: int, hot_runs: int = HOT_RUNS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(gram, run, gone): for distinct runs, the offsets whose string occurs earlier in another distinct run."""
    heavy = texts.groupBy("gram").agg(F.count("*").alias("k")).where(F.col("k") > hot_runs).select("gram")
    total = texts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = texts.join(heavy, "gram", "left_anti").withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)))
    indexed = dealt.groupBy("block").applyInArrow(_repeats_in_block(size, block_bytes), "gram long, run long, gone array<long>")
    single = texts.join(heavy, "gram", "left_semi").mapInArrow(_single_strings(size), "gram long, run long, doc_id long, th long, start long, at long, a long, b long")
    place = F.struct("doc_id", "th", "start")
    first = single.groupBy("gram", "a", "b").agg(F.min(place).alias("first"))
    grouped = single.join(first, ["gram", "a", "b"]).where(F.col("first") < place).groupBy("gram", "run").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    return indexed.unionByName(grouped)


def _covered(starts, counts, size, length):
    edge = np.zeros(length + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts + size - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeated_strings(docs: DataFrame, size: int = 100, bits: int = BITS, hot_runs: int = HOT_RUNS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed stretches) and the bytes left (``kept``)."""
    rows = doc_rows(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    context = rows.sparkSession.sparkContext
    grams = sketch(rows.select("text"), lambda batch: [_runs(data, offsets, size)[4] for _, _, data, offsets in text_chunks(batch, "text")], bits, 2)
    bitmap = context.broadcast(grams)
    whole = stored(distinct_runs(rows, bitmap, size, bits))
    varied = whole.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram")
    wanted = stored(whole.join(varied, "gram", "left_semi"))
    texts = stored(run_texts(rows, bitmap, wanted, size, bits).join(wanted.select("gram", "run", "doc_id", "th", "start"), ["gram", "run", "doc_id", "th", "start"], "left_semi"))
    inside = repeats_inside(texts, size, hot_runs, block_bytes)
    kept_runs = (
        whole.join(inside, ["gram", "run"], "left").groupBy("doc_id", "th")
        .agg(F.collect_list("start").alias("kept_runs"), F.flatten(F.collect_list(F.transform("gone", lambda g: g + F.col("start")))).alias("gone"))
    )
    marked = rows.join(kept_runs, ["doc_id", "th"], "left").select("doc_id", "text", "kept_runs", "gone")

    def cut(batches):
        for batch in batches:
            earliest, gone = (batch.column(c).to_pylist() for c in ("kept_runs", "gone"))
            for lo, hi, data, offsets, doc, first, count, _, _ in _candidates(batch, size, bitmap.value, bits):
                stays = [np.asarray(earliest[lo + d] or (), np.int64) + offsets[d] for d in range(hi - lo)]
                later = ~np.isin(first, np.concatenate(stays))
                inner = np.concatenate([np.asarray(gone[lo + d] or (), np.int64) + offsets[d] for d in range(hi - lo)])
                starts = np.concatenate((first[later], inner))
                out = _covered(starts, np.concatenate((count[later], np.ones(len(inner), np.int64))), size, len(data))
                opens = out.copy()
                opens[1:] &= ~out[:-1]
                opens[offsets[:-1][np.diff(offsets) > 0]] |= out[offsets[:-1][np.diff(offsets) > 0]]
                removed, spans = (np.diff(np.append(0, np.cumsum(x))[offsets]) for x in (out, opens))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed.astype(np.int64)), "n_spans": pa.array(spans.astype(np.int64)),
                    "kept": pa.array([data[a:b][~out[a:b]].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary()),
                })

    cleaned = marked.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return cleaned.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))


def query(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeated_strings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 99)) AS i, h FROM d WHERE length(h) >= 200),
g AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
b AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS opens FROM r),
q AS (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM b),
v AS (SELECT doc_id, span, min(i) AS a, max(i) + 100 AS z FROM q GROUP BY doc_id, span),
f AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM v),
t AS (
  SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans,
    string_agg(substr(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS head, max(z) AS last
  FROM f JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
