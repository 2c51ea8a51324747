"""Facet counts below a path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.functions.values import facet_child, facet_path
from textquarry.plans.frames import matching, share
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import FACET


@dataclass(frozen=True)
class Facet:
    """Children of ``path`` in a facet field, the ``limit`` largest of them."""

    field: str
    path: Sequence[str] = ()
    limit: int = 10


def _labels(paths: Column, where: str, request: int) -> Column:
    """The distinct children of ``where`` among the paths of a row, each with the number of the request."""
    children = F.array_compact(F.array_distinct(F.transform(paths, lambda p: facet_child(p, where))))
    return F.transform(children, lambda c: F.struct(F.lit(request).alias("request"), c.alias("label")))


def facet_counts(corpus: Corpus, facets: Sequence[Facet], query: Query | None = None) -> DataFrame:
    """``request, field, label, count, total_count, child_count``, largest children first.

    A row counts once per child it falls under; rows exactly at the path do not
    count. ``total_count`` and ``child_count`` cover all children, not only the
    ones returned. ``request`` is the position in ``facets``.
    """
    if not facets:
        raise RequestError("no facet requested")
    rows = matching(corpus, query, columns=list(dict.fromkeys(f.field for f in facets)))
    found = []
    for i, facet in enumerate(facets):
        spec = corpus.spec(facet.field)
        if spec.kind != FACET:
            raise RequestError(f"{facet.field!r} is not a facet field")
        where = facet_path(facet.path)
        paths = spec.column if spec.multi else F.array(spec.column)
        found.append(_labels(paths, where, i))
    # One pass for all requests: a row's distinct children are found inside the row.
    labels = rows.select(F.explode(F.flatten(F.array(*[F.coalesce(f, F.array().cast("array<struct<request:int,label:string>>")) for f in found]))).alias("f"))
    counts = share(labels.groupBy("f.request", "f.label").agg(F.count(F.lit(1)).alias("count")))
    totals = counts.groupBy("request").agg(F.sum("count").alias("total_count"), F.count(F.lit(1)).alias("child_count"))
    place = F.row_number().over(W.partitionBy("request").orderBy(F.desc("count"), "label"))
    of_request = lambda values: F.get(F.array(*map(F.lit, values)), F.col("request"))
    top = counts.withColumn("__place", place).where(F.col("__place") <= max(f.limit for f in facets)).where(F.col("__place") <= of_request([f.limit for f in facets]))
    return top.join(F.broadcast(totals), "request").orderBy("request", "__place").select(
        "request", of_request([f.field for f in facets]).alias("field"), "label", "count", "total_count", "child_count")
