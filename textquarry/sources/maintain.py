"""Corpus maintenance: every operation returns a new corpus over new rows.

Nothing is changed in place. Writing the result (``Corpus.save``) is the commit;
``streaming.ingest`` keeps a stored corpus up to date batch by batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.errors import FieldError
from textquarry.plans.compiler import Compiler
from textquarry.plans.features import scan_base
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import literal


def check_rows(corpus: Corpus, rows: DataFrame) -> DataFrame:
    """``rows`` with the corpus' columns; unknown columns and other types are errors."""
    have = {f.name: f.dataType for f in corpus.df.schema.fields}
    for f in rows.schema.fields:
        if f.name not in have:
            raise FieldError(f"unknown column {f.name!r}")
        if f.dataType != have[f.name] and not isinstance(f.dataType, T.NullType):
            raise FieldError(
                f"column {f.name!r} is {have[f.name].simpleString()}, got {f.dataType.simpleString()}"
            )
    given = set(rows.columns)
    return rows.select(*[
        F.col(f"`{n}`") if n in given else F.lit(None).cast(t).alias(n) for n, t in have.items()
    ])


def append(corpus: Corpus, rows: DataFrame) -> Corpus:
    """Add rows. Columns may be left out (missing values); ids are not checked."""
    return corpus.with_df(corpus.df.unionByName(check_rows(corpus, rows)))


def latest(rows: DataFrame, key: str, order_by: str) -> DataFrame:
    """The last row of each id by ``order_by``."""
    last = W.partitionBy(key).orderBy(F.desc(order_by))
    return rows.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def upsert(corpus: Corpus, rows: DataFrame, *, id_col: str | None = None, order_by: str | None = None,
           replaces: str | None = None) -> Corpus:
    """Replace rows by id.

    With ``order_by``, only the last row of each id in ``rows`` is kept;
    without, an id that comes twice there is an error when the result is read. ``id_col`` overrides the corpus
    id. ``replaces`` names a column of ``rows`` holding the id to remove, when
    that is not the new row's own id.
    """
    key = id_col or corpus.key()
    if order_by is not None:
        rows = latest(rows, replaces or key, order_by)
    else:
        single = F.count(F.lit(1)).over(W.partitionBy(replaces or key)) == 1
        rows = rows.withColumn("__single", single).where(F.assert_true("__single", "upsert: an id comes twice; give order_by").isNull()).drop("__single")
    extra = {c for c in (order_by, replaces) if c and c not in corpus.df.columns}
    gone = rows.select(F.col(f"`{replaces or key}`").alias(key))
    kept = corpus.df.join(gone, key, "left_anti").select(*[f"`{c}`" for c in corpus.df.columns])
    return corpus.with_df(kept.unionByName(check_rows(corpus, rows.drop(*extra))))


def delete(corpus: Corpus, ids, *, id_col: str | None = None) -> Corpus:
    """Remove every row with one of the ids (a list, or a DataFrame with the id column)."""
    key = id_col or corpus.key()
    spec = corpus.spec(key)
    if isinstance(ids, DataFrame):
        kept = corpus.df.join(ids.select(key), key, "left_anti")
        return corpus.with_df(kept.select(*[f"`{c}`" for c in corpus.df.columns]))
    values = [literal(spec, v) for v in ids]
    hit = F.coalesce(spec.any_value(lambda v: v.isin(*values)), F.lit(False)) if values else F.lit(False)
    return corpus.with_df(corpus.df.where(~hit))


@dataclass
class Deletion:
    corpus: Corpus
    removed: DataFrame  # one row: ``removed``


def delete_where(corpus: Corpus, query: Query) -> Deletion:
    """Remove the rows matching a query; ``removed`` gives the exact number."""
    compiler = Compiler(corpus)
    part = compiler.compile(query)
    frame = compiler.features.scan_frame(scan_base(corpus, compiler.features))
    hit = F.coalesce(part.match, F.lit(False))
    kept = frame.where(~hit).select(*[f"`{c}`" for c in corpus.df.columns])
    return Deletion(corpus.with_df(kept), frame.agg(F.count_if(hit).alias("removed")))


def truncate(corpus: Corpus) -> Corpus:
    """Remove every row, keep the schema."""
    return corpus.with_df(corpus.df.where(F.lit(False)))
