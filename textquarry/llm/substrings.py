"""Removal of word windows that already stand in an earlier document (count-min prefilter, exact second pass).

Every window of ``size`` words is filed under the least of its word grams. A first scan counts these grams in a
count-min sketch per partition; the sketches are merged by adding counters, so the count of a window's gram bounds
the window's own count from above. A second scan keeps only windows whose gram may occur twice, in runs of
neighbouring windows with one gram, and groups those exactly: first whole runs, then the single windows of runs
that differ. No repeated window is lost, whatever the sketch's width; a full sketch only lets more windows through.

Defined cases: a null text has no words; a text of fewer words than ``size`` has no window; a null id counts as
smaller than every other; rows that share an id never remove each other's words; equal rows give equal rows;
other columns fall away. Texts are handled whole (working memory of a task: about 40 times its longest text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.arrays import Rolling, text_chunks, window_runs, word_bounds, word_hashes
from textquarry.llm.common import doc_rows, stored
from textquarry.llm.sketch import passes, sketch

GRAM = 16
NULL_ID = -(1 << 63)


def _runs(data, offsets, size):
    starts, ends = word_bounds(data, offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    rolling = Rolling(word_hashes(data, starts, ends))
    first, count, gram = window_runs(rolling, owner, size, min(GRAM, size))
    return rolling, np.searchsorted(starts, offsets), owner, first, count, gram


def candidate_runs(rows: DataFrame, size: int, bits: int) -> DataFrame:
    """Runs of windows whose gram may repeat: place, number of windows, digests of gram, run and each window."""
    bitmap = rows.sparkSession.sparkContext.broadcast(sketch(
        rows.select("text"), lambda batch: [_runs(data, offsets, size)[5] for _, _, data, offsets in text_chunks(batch, "text")], bits, 2))

    def keep(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, "text"):
                rolling, begins, owner, first, count, gram = _runs(data, offsets, size)
                hit = passes(bitmap.value, gram, bits)
                first, count, gram = first[hit], count[hit], gram[hit]
                if not len(first):
                    continue
                doc = owner[first]
                bounds = np.concatenate(([0], np.cumsum(count)))
                each = np.repeat(first - bounds[:-1], count) + np.arange(bounds[-1])
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo).take(pa.array(doc)),
                    "th": batch.column("th").slice(lo, hi - lo).take(pa.array(doc)),
                    "start": pa.array((first - begins[doc]).astype(np.int64)),
                    "n": pa.array(count.astype(np.int64)),
                    "gram": pa.array(gram.view(np.int64)),
                    "run": pa.array(rolling.stretch(first, first + count + size - 1).view(np.int64)),
                    "windows": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(rolling.stretch(each, each + size).view(np.int64))),
                })

    return rows.mapInArrow(keep, "doc_id long, th long, start long, n long, gram long, run long, windows array<long>")


def covered_windows(runs: DataFrame) -> DataFrame:
    """(doc_id, th, start, n): stretches of windows that also start in a document with a smaller id."""
    order = F.coalesce("doc_id", F.lit(NULL_ID))
    whole = stored(runs.withColumn("doc_id", order).groupBy("gram", "run").agg(F.min("doc_id").alias("least"), F.any_value("windows").alias("windows")))
    varied = stored(whole.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram"))
    single = whole.join(varied, "gram").select("gram", "run", "least", F.posexplode("windows").alias("at", "window"))
    earliest = single.groupBy("gram", "window").agg(F.min("least").alias("first"), F.max("least").alias("last")).where("first < last").select("gram", "window", "first")
    known = (
        single.join(earliest, ["gram", "window"]).where("first < least")
        .groupBy("gram", "run").agg(F.sort_array(F.collect_list(F.col("at").cast("long"))).alias("known"))
    )
    least = stored(whole.select("gram", "run", "least").join(known, ["gram", "run"], "left"))
    placed = runs.select("doc_id", "th", "start", "n", "gram", "run").join(least, ["gram", "run"])
    later = F.coalesce("doc_id", F.lit(NULL_ID)) > F.col("least")
    spans = F.when(later, F.array(F.struct(F.col("start"), F.col("n")))).otherwise(
        F.transform("known", lambda at: F.struct((F.col("start") + at).alias("start"), F.lit(1).cast("long").alias("n"))))
    return placed.where(later | F.col("known").isNotNull()).select("doc_id", "th", F.explode(spans).alias("s")).select("doc_id", "th", "s.start", "s.n")


def remove_repeated_windows(docs: DataFrame, size: int = 50, bits: int = 26) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the kept words joined by one space (``kept``)."""
    rows = doc_rows(docs)
    runs = stored(candidate_runs(rows, size, bits))
    spans = (
        covered_windows(runs).groupBy("doc_id", "th")
        .agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n") + size - 1).alias("end")))).alias("spans"))
        .select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), "spans")
    )
    marked = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("hash")), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for batch in batches:
            words, removed, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                all_words = text.as_py().encode().split()
                left, at, spans = [], 0, spans.as_py() or ()
                for span in spans:
                    left += all_words[at:span["start"]]
                    at = max(at, span["end"])
                left += all_words[at:]
                words.append(len(all_words))
                removed.append(len(all_words) - len(left))
                kept.append(b" ".join(left).decode())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return marked.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), p AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM w WHERE len(words) >= 50
), g AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS seq FROM p
), m AS (SELECT seq, min(doc_id) AS first FROM g GROUP BY seq),
c AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g JOIN m USING (seq) WHERE m.first < g.doc_id
), r AS (SELECT doc_id, list(j) AS gone FROM c GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda x, k: NOT list_contains(gone, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)
"""
