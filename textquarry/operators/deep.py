"""Pages at any depth of a global order, without a task that holds all ranks before them.

Rows are dealt by ranges of their sort keys and sorted inside each range; the narrow result is written to the shared
scratch folder, one file per range in the order of the ranges. The rows of each file are counted, a running sum of the
counts gives every file its first rank, and the place of a row in its file gives its own. Only the files that the page
touches are read back. The counts, one per file, are all the driver sees.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.operators.search import BROADCAST_PAGE, Relevance, sort_columns
from textquarry.plans.frames import SCORE, matching
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.scratch import scratch_path


class GlobalOrder:
    """All matching rows of a request in order; ``page`` reads any stretch of ranks. ``total`` is their number."""

    def __init__(self, corpus: Corpus, written: DataFrame, files: list[tuple[str, int, int]], scored: bool):
        self.corpus, self.written, self.files, self.scored = corpus, written, files, scored
        self.total = files[-1][2] if files else 0

    @classmethod
    def of(cls, corpus: Corpus, query: Query | None = None, sort: Sequence = (Relevance(),), min_score: float | None = None) -> GlobalOrder:
        """Runs two jobs: the order is written, and its files are counted."""
        order, reads, ranked = sort_columns(corpus, tuple(sort) or (Relevance(),))
        scored = ranked or min_score is not None
        rows = matching(corpus, query, scored=scored, columns=reads)
        if min_score is not None:
            rows = rows.where(F.col(SCORE) >= min_score)
        path, spark = scratch_path(corpus.spark, "order"), corpus.spark
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
        places = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at")
        written = spark.read.schema(rows.schema).parquet(path).select("*", *places)
        counted = written.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()
        counted.sort(key=lambda r: r["__file"].rsplit("/", 1)[1])  # files are named in the order of the ranges
        ends = list(accumulate(r.n for r in counted))
        return cls(corpus, written, [(r["__file"], end - r.n, end) for r, end in zip(counted, ends)], scored)

    def page(self, limit: int, offset: int = 0, return_fields: Sequence[str] = ()) -> DataFrame:
        """``rank``, ``id`` and ``score`` where the order has them, and the columns asked for, of one stretch of ranks."""
        if limit < 0 or offset < 0:
            raise RequestError("limit and offset must not be negative")
        touched = [(file, start) for file, start, end in self.files if start < offset + limit and end > offset]
        starts = self.corpus.spark.createDataFrame(touched, "__file string, __start long")
        rows = self.written.where(F.col("__file").isin([file for file, _ in touched])).join(F.broadcast(starts), "__file")
        rows = rows.withColumn("rank", F.col("__start") + F.col("__at") + 1).drop("__file", "__start", "__at")
        rows = rows.where(F.col("rank").between(offset + 1, offset + limit))
        missing = [c for c in return_fields if c not in rows.columns]
        if missing:
            wanted = self.corpus.df.select(f"`{self.corpus.key()}`", *[f"`{c}`" for c in missing])
            rows = wanted.join(F.broadcast(rows) if limit <= BROADCAST_PAGE else rows, self.corpus.key())
        head = ["rank"]
        if self.corpus.id_col:
            head.append(self.corpus.id_text().alias("id"))
        if self.scored:
            head.append(F.col(SCORE).alias("score"))
        return rows.select(*head, *[f"`{c}`" for c in return_fields])
