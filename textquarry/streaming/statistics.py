"""Corpus statistics kept by a stateful stream: row count, field length, and per term its rows and occurrences.

Two of Spark's stateful operators in a row: ids already seen are dropped, then the counts per term are kept as state,
which is dealt over the tasks by term. Each micro-batch writes the new totals of the terms it touched into a folder of
its own; the newest total of a term counts. A replayed batch overwrites its folder with the same totals, and a restarted
stream goes on from its checkpoint.

Defined cases: a row without an id is left out; of rows with one id the first to arrive counts, whatever its text; a null
text is a row of length zero. With ``time_col`` and ``delay`` ids are remembered for ``delay`` of event time only: a row
older than the watermark is dropped and counted in the query's progress, and a copy of an id must come within ``delay``.
Without them every id is remembered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textquarry.functions.analysis import token_slots
from textquarry.functions.values import let
from textquarry.streaming.ingest import BATCH, run_batches

SCHEMA = f"term string, n_rows long, n_terms long, {BATCH} long"


def _terms(text: Column, analyzer: str) -> Column:
    """The tokens of a text, each with whether it is the first of its kind; a null term holds the number of all."""
    tokens = F.array_compact(F.coalesce(token_slots(text, analyzer), F.array().cast("array<string>")))

    def marked(ordered: Column) -> Column:
        entry = lambda term, first, n: F.struct(term.alias("term"), first.cast("long").alias("first"), n.cast("long").alias("n"))
        each = F.transform(ordered, lambda t, i: entry(t, (i == 0) | (t != F.get(ordered, i - 1)), F.lit(1)))
        return F.array_append(each, entry(F.lit(None).cast("string"), F.lit(1), F.size(ordered)))

    return let(F.array_sort(tokens), marked)


def count_terms(rows: DataFrame, text_col: str, analyzer: str = "default") -> DataFrame:
    """``term, n_rows, n_terms`` over the rows; of the null term, the number of rows and of all tokens."""
    single = rows.select(F.explode(_terms(F.col(text_col), analyzer)).alias("t"))
    return single.groupBy("t.term").agg(F.sum("t.first").alias("n_rows"), F.sum("t.n").alias("n_terms"))


def statistics_stream(stream: DataFrame, path: str, checkpoint: str, *, id_col: str, text_col: str, analyzer: str = "default",
                      time_col: str | None = None, delay: str = "1 day", **trigger) -> StreamingQuery:
    """Keep the statistics of the rows that arrive in ``stream`` under ``path``."""
    rows = stream.where(F.col(id_col).isNotNull())
    if time_col is None:
        rows = rows.dropDuplicates([id_col])
    else:
        rows = rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])
    counts = count_terms(rows, text_col, analyzer)
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={n}")
    return run_batches(counts, write, checkpoint, "update", **trigger)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """``term, n_rows, n_terms`` as of the last finished batch; the null term holds the totals."""
    newest = F.max_by(F.struct("n_rows", "n_terms"), BATCH).alias("now")
    return spark.read.schema(SCHEMA).parquet(path).groupBy("term").agg(newest).select("term", "now.*")
