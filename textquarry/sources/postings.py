"""A stored term index: postings, term dictionary and field lengths as Parquet.

``postings`` has one row per (field, term, row id). Each task writes the postings
of its own rows, sorted by (term, id): a file is a segment of the corpus, a query
reads only the pages of its own terms in each, and a very common term is spread
over all files. Nothing is shuffled for it, and each text is analysed once (ranges
over all terms need a sample, which would analyse every text a second time).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.plans.features import Features, phrase_count_from_positions
from textquarry.plans.terms import term_rows
from textquarry.sources.corpus import Corpus
from textquarry.sources.patterns import Needed, PatternIndex

#: A pattern that fits at most this many dictionary terms is sent to the scan as
#: a list of terms; one that fits more is evaluated on the postings themselves.
INLINE_TERMS = 2000


def _write_postings(rows: DataFrame, path: str, mode: str) -> None:
    """Every partition sorted by term and id, so that a query reads the pages of its terms."""
    rows.sortWithinPartitions("field", "term", "doc_id").write.mode(mode).partitionBy("field").parquet(f"{path}/postings")


def _lengths(stored: DataFrame, fields: list[str], n_docs: int) -> DataFrame:
    """Per field the number of rows and of tokens."""
    totals = stored.groupBy("field").agg(F.sum("tf").alias("total"))
    names = stored.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    return names.join(totals, "field", "left").select(
        "field", F.lit(n_docs).cast("bigint").alias("n"), F.coalesce("total", F.lit(0)).alias("total"))


class TermIndex:
    def __init__(self, postings: DataFrame, terms: DataFrame, lengths: DataFrame, patterns: PatternIndex | None = None):
        self.postings, self.terms, self.lengths, self.patterns = postings, terms, lengths, patterns

    def with_patterns(self, patterns: PatternIndex) -> TermIndex:
        """The same index looking patterns and misspellings up in ``patterns``, built from its dictionary."""
        return TermIndex(self.postings, self.terms, self.lengths, patterns)

    @classmethod
    def build(cls, corpus: Corpus, path: str, fields: list[str] | None = None, mode: str = "errorifexists") -> TermIndex:
        """Write the index of ``fields`` (all text fields by default) under ``path``."""
        fields = fields or corpus.text_fields
        _write_postings(term_rows(corpus, fields, positions=True), path, mode)
        return cls._summarise(corpus.spark, path, fields, corpus.df.count(), mode)

    @classmethod
    def _summarise(cls, spark: SparkSession, path: str, fields: list[str], n_docs: int, mode: str) -> TermIndex:
        """Dictionary and lengths from the stored postings."""
        stored = spark.read.parquet(f"{path}/postings")
        (
            stored.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
            .sortWithinPartitions("field", "term").write.mode(mode).partitionBy("field").parquet(f"{path}/terms")
        )
        _lengths(stored, fields, n_docs).write.mode(mode).parquet(f"{path}/lengths")
        return cls.open(spark, path)

    @classmethod
    def gather(cls, corpus: Corpus, path: str, fields: list[str]) -> TermIndex:
        """An index for one request that reads all of it: no positions, no order, the dictionary counted when it is read."""
        term_rows(corpus, fields, positions=True).drop("positions").write.parquet(f"{path}/postings")
        stored = corpus.spark.read.parquet(f"{path}/postings")
        _lengths(stored, fields, corpus.df.count()).write.parquet(f"{path}/lengths")
        terms = stored.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
        return cls(stored, terms, corpus.spark.read.parquet(f"{path}/lengths"))

    def _held(self) -> tuple[list[str], int]:
        rows = self.lengths.collect()  # one row per field
        return [r.field for r in rows], max([r.n for r in rows], default=0)

    def append(self, added: Corpus, path: str) -> TermIndex:
        """The index at ``path`` with the rows of ``added`` too: only their texts are analysed, the dictionary is summed anew."""
        fields, n = self._held()
        _write_postings(term_rows(added, fields, positions=True), path, "append")
        return self._summarise(added.spark, path, fields, n + added.df.count(), "overwrite")

    def remove(self, gone: DataFrame, target: str) -> TermIndex:
        """The index at ``target`` without the rows whose ids are in ``gone`` (one column, each an id of an indexed row)."""
        fields, n = self._held()
        gone = gone.toDF("doc_id").distinct()
        _write_postings(self.postings.join(gone, "doc_id", "left_anti"), target, "errorifexists")
        return self._summarise(gone.sparkSession, target, fields, n - gone.count(), "errorifexists")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> TermIndex:
        return cls(*[spark.read.parquet(f"{path}/{t}") for t in ("postings", "terms", "lengths")])

    # -- answering a query -----------------------------------------------------

    def fitting(self, field: str, predicate, needed: Needed | None = None) -> DataFrame:
        """``term`` of the dictionary entries that pass a test; only those that can, where a pattern index tells them."""
        if self.patterns is not None and self.patterns.answers(needed):
            return self.patterns.candidates(field, needed).where(predicate(F.col("term")))
        return self.terms.where((F.col("field") == field) & predicate(F.col("term"))).select("term")

    def _resolve(self, field: str, predicate, needed: Needed | None = None) -> Column:
        """A test on terms as a scan condition (see ``INLINE_TERMS``)."""
        hits = self.fitting(field, predicate, needed)
        found = [r.term for r in hits.select("term").limit(INLINE_TERMS + 1).collect()]
        test = F.col("term").isin(found) if len(found) <= INLINE_TERMS else predicate(F.col("term"))
        return (F.col("field") == field) & test

    def frame(self, features: Features) -> DataFrame:
        """Feature columns per row id, for the rows having at least one term asked for."""
        def is_term(f, t):
            return (F.col("field") == f) & (F.col("term") == t)

        tests = {n: self._resolve(f, p, features.needed.get(n)) for n, (f, p) in features.tests.items()}
        slots: dict[str, Column] = {}   # one position column per phrase slot
        conditions = [is_term(f, t) for f, t in features.terms] + list(tests.values())
        aggs = []
        for (f, t), name in features.terms.items():
            aggs.append(F.coalesce(F.max(F.when(is_term(f, t), F.col("tf"))), F.lit(0)).alias(name))
        for name, test in tests.items():
            aggs.append(F.coalesce(F.bool_or(test), F.lit(False)).alias(name))
        for f, name in features.lengths.items():
            aggs.append(F.coalesce(F.max(F.when(F.col("field") == f, F.col("dl"))), F.lit(0)).alias(name))
        for spec, name in features.phrases.items():
            for k in range(len(spec.terms)):
                here = (F.col("field") == spec.field) & spec.fits(k, F.col("term"))
                slots[f"{name}_{k}"] = here
                conditions.append(here)
        aggs += [F.flatten(F.collect_list(F.when(c, F.col("positions")))).alias(n) for n, c in slots.items()]

        rows = features.attach_lookups(self.postings)
        rows = rows.where(reduce(lambda a, b: a | b, conditions))
        out = rows.groupBy("doc_id").agg(*aggs)
        for spec, name in features.phrases.items():
            columns = [F.col(f"{name}_{k}") for k in range(len(spec.terms))]
            out = out.withColumn(name, phrase_count_from_positions(columns, spec.slop))
        return out.drop(*slots)

    def totals(self, features: Features, corpus: Corpus) -> DataFrame:
        """One row of corpus statistics, without reading any text."""
        wanted = list(features.term_stats)
        fields = list(dict.fromkeys([f for f, _ in wanted] + list(features.length_stats)))
        if wanted:
            listed = reduce(lambda a, b: a | b, [
                (F.col("field") == f) & F.col("term").isin([t for g, t in wanted if g == f]) for f in fields
                if any(g == f for g, _ in wanted)
            ])
        else:
            listed = F.lit(False)
        counts = self.terms.where(listed).agg(F.struct(F.lit(0).alias("_"), *[
            F.coalesce(F.max(F.when((F.col("field") == f) & (F.col("term") == t), F.col("df"))), F.lit(0)).alias(f"df_{s}")
            for (f, t), s in features.term_stats.items()
        ]).alias("c"))
        out = self.lengths.agg(
            F.max("n").alias("n"),
            *[F.max(F.when(F.col("field") == f, F.col("total"))).alias(f"sum_{s}")
              for f, s in features.length_stats.items()],
        ).withColumn("__c", counts.scalar()).select("*", "__c.*").drop("__c")
        if features.row_stats:
            aggs = []
            for s, (match, n_values) in features.row_stats.items():
                aggs += [F.count_if(match).alias(f"df_{s}"), F.sum(n_values).alias(f"sum_{s}")]
            rows = corpus.df.agg(F.struct(*aggs).alias("r"))
            out = out.withColumn("__r", rows.scalar()).select("*", "__r.*").drop("__r")
        return out
