"""Score breakdowns for any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.plans.compiler import Compiler
from textquarry.plans.frames import scoring_frame
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import literal


def explain_scores(corpus: Corpus, query: Query, ids=None) -> DataFrame:
    """One row per (row id, query node): what it saw and what it contributed.

    ``ids`` is a list of ids, a DataFrame with the id column, or None for every row. ``path`` places
    the node in the query tree; the row with path "0" carries the total. Unknown
    ids give no rows. Statistics are those of the whole corpus.
    """
    key = corpus.key()
    if ids is not None and not isinstance(ids, DataFrame):
        spec = corpus.spec(key)
        for v in ids:
            literal(spec, v)
        ids = corpus.spark.createDataFrame([(v,) for v in ids], corpus.df.select(key).schema)
    compiler = Compiler(corpus)
    part = compiler.compile(query)
    frame = scoring_frame(corpus, compiler, part, [key])
    if ids is not None:
        frame = frame.join(ids.select(key), key, "left_semi")
    nodes = [
        F.struct(
            F.lit(d["path"]).alias("path"),
            F.lit(d["node"]).alias("node"),
            F.lit(d.get("field")).cast("string").alias("field"),
            F.lit(d.get("term")).cast("string").alias("term"),
            F.coalesce(d["match"], F.lit(False)).alias("matched"),
            _number(d, "tf", "bigint"),
            _number(d, "df", "bigint"),
            _number(d, "length", "bigint"),
            _number(d, "idf", "double"),
            F.when(d["match"], d["score"]).otherwise(0.0).cast("double").alias("contribution"),
        )
        for d in part.details
    ]
    return frame.select(F.col(f"`{key}`").alias("doc_id"), F.inline(F.array(*nodes)))


def _number(detail: dict, name: str, kind: str):
    return F.expr(f"CAST({detail.get(name) or 'NULL'} AS {kind}) AS {name}")
