"""Lookups in a field's term dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.functions.analysis import field_slots
from textquarry.sources.corpus import Corpus, spread


def first_terms(corpus: Corpus, field: str, prefix: str, limit: int) -> DataFrame:
    """One row holding the first ``limit`` distinct terms that begin with ``prefix``."""
    if corpus.index is not None:
        terms = corpus.index.terms.where((F.col("field") == field) & F.col("term").startswith(prefix)).select("term")
    else:
        base = spread(corpus.df, corpus.id_col) if corpus.id_col else corpus.df
        hits = F.filter(field_slots(corpus.spec(field)), lambda t: t.startswith(prefix))
        terms = base.select(F.explode(F.array_distinct(hits)).alias("term")).distinct()
    first = terms.orderBy("term").limit(limit)
    return first.agg(F.coalesce(F.collect_list("term"), F.array().cast("array<string>")).alias("terms"))
