"""Distinct values of a field, whole or page by page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.functions.analysis import field_slots
from textquarry.plans.frames import matching
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import CURSOR_KINDS, TEXT, literal


def distinct_values(corpus: Corpus, field: str, query: Query | None = None) -> DataFrame:
    """Every distinct value among matching rows as ``value``; tokens for a text field."""
    return _values(corpus, field, query, None).distinct()


def _values(corpus: Corpus, field: str, query: Query | None, cursor) -> DataFrame:
    spec = corpus.spec(field)
    rows = matching(corpus, query, columns=[field])
    if spec.kind == TEXT:
        value = F.explode(F.array_distinct(field_slots(spec)))
    else:
        value = F.explode(spec.values()) if spec.multi else spec.column
    values = rows.select(value.alias("value")).where(F.col("value").isNotNull())
    return values if cursor is None else values.where(F.col("value") > literal(spec, cursor))


def distinct_page(corpus: Corpus, field: str, page_size: int, cursor=None, query: Query | None = None) -> DataFrame:
    """The next ``page_size`` distinct values after ``cursor``, ascending.

    The cursor is exclusive and, for single-valued fields, a filter on the scan.
    """
    if page_size < 1:
        raise RequestError("page_size must be at least 1")
    spec = corpus.spec(field)
    if cursor is not None and spec.kind not in CURSOR_KINDS:
        raise RequestError(f"paging is not supported on {spec.kind} field {field!r}")
    return _values(corpus, field, query, cursor).distinct().orderBy("value").limit(page_size)


def next_cursor(page: list, page_size: int):
    """Cursor after a collected page: its last value if the page is full, else None."""
    return page[-1][0] if len(page) == page_size else None
