"""Ranked retrieval: top-k, sort, paging, payload shapes, counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.errors import RequestError
from textquarry.functions.values import epoch_millis
from textquarry.operators.facets import Facet, facet_counts
from textquarry.operators.snippets import Snippet, add_snippets
from textquarry.plans.frames import SCORE, matching
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import SORT_KINDS

#: A page of hits up to this size is joined back to its rows by broadcast.
BROADCAST_PAGE = 10_000
#: A page comes out of its sort in one partition; larger ones are spread before highlighting.
ONE_TASK_PAGE = 1_000


@dataclass(frozen=True)
class Relevance:
    descending: bool = True


@dataclass(frozen=True)
class ByField:
    field: str
    descending: bool = False


@dataclass(frozen=True)
class IndexOrder:
    descending: bool = False


def sort_columns(corpus: Corpus, sort: Sequence) -> tuple[list[Column], list[str], bool]:
    """Ordering columns, the corpus columns they read, and whether a score is needed.

    Missing values come before present ones ascending and after them
    descending; the row key makes every order total.
    """
    order, reads, scored = [], [], False
    for s in sort:
        if isinstance(s, Relevance):
            scored = True
            order.append(F.col(SCORE).desc() if s.descending else F.col(SCORE).asc())
        elif isinstance(s, IndexOrder):
            if corpus.seq_col is None:
                raise RequestError("index order needs a corpus with an id or sequence column")
            reads.append(corpus.seq_col)
            order.append(F.col(corpus.seq_col).desc() if s.descending else F.col(corpus.seq_col).asc())
        elif isinstance(s, ByField):
            spec = corpus.spec(s.field)
            if spec.kind not in SORT_KINDS:
                raise RequestError(f"cannot sort by {spec.kind} field {s.field!r}")
            reads.append(s.field)
            value = spec.first()
            order.append(value.desc_nulls_last() if s.descending else value.asc_nulls_first())
        else:
            raise RequestError(f"not a sort clause: {s!r}")
    for name in dict.fromkeys(c for c in (corpus.seq_col, corpus.id_col) if c):
        reads.append(name)
        order.append(F.col(f"`{name}`").asc())
    return order, list(dict.fromkeys(reads)), scored


def _payload(corpus: Corpus, mode: str, fields: Sequence[str]) -> list[Column]:
    columns = corpus.df.columns
    for f in fields:
        if f not in columns:
            raise RequestError(f"no column {f!r} to return")
    if mode in ("doc", "doc_and_indexes"):  # columns hold both
        return [F.col(f"`{c}`") for c in columns]
    if mode == "materialized":
        return [F.col(f"`{c}`") for c in (fields or columns)]
    if mode == "value":
        if not fields:
            raise RequestError("payload='value' needs one name in return_fields")
        spec = corpus.fields.get(fields[0])
        return [(spec.first() if spec else F.col(f"`{fields[0]}`")).alias("value")]
    if mode == "json":
        return [json_payload(corpus, list(fields) or columns).alias("json")]
    raise RequestError(f"payload must be doc, doc_and_indexes, value, json or materialized, not {mode!r}")


def json_payload(corpus: Corpus, names: Sequence[str]) -> Column:
    """One JSON object: single values as scalars, several as arrays, bytes as hex, dates as millis."""
    parts = []
    for n in names:
        spec = corpus.fields.get(n)
        c = F.col(f"`{n}`")
        if spec is None:
            parts.append(c.alias(n))
            continue
        if spec.kind == "bytes":
            shown = lambda v: F.lower(F.hex(v))
        elif spec.kind == "date":
            shown = lambda v, kind=spec.element_type: epoch_millis(v, kind)
        elif spec.kind == "json" and isinstance(spec.element_type, T.StringType):
            shown = F.try_parse_json
        else:
            shown = lambda v: v
        if not spec.multi:
            parts.append(shown(c).alias(n))
            continue
        # One value is shown bare, several as a list: a variant can be either.
        many = F.transform(F.array_compact(c), shown)
        as_variant = lambda v: F.parse_json(F.to_json(v))
        one = F.get(F.from_json(F.to_json(many), "array<variant>"), F.lit(0))
        parts.append(F.when(F.size(many) == 1, one).when(F.size(many) > 1, as_variant(many)).alias(n))
    return F.to_json(F.struct(*parts))


def search(
    corpus: Corpus,
    query: Query | None = None,
    *,
    limit: int = 10,
    offset: int = 0,
    sort: Sequence = (Relevance(),),
    min_score: float | None = None,
    with_score: bool = True,
    payload: str = "doc",
    return_fields: Sequence[str] = (),
    snippets: Sequence[Snippet] = (),
) -> DataFrame:
    """One page of hits: ``rank``, ``id`` and ``score`` where available, payload, snippets.

    ``rank`` starts at ``offset + 1``. ``min_score`` applies before paging, and
    real scores are kept under a field sort. Nothing runs before the result is used.
    """
    if limit < 0 or offset < 0:
        raise RequestError("limit and offset must not be negative")
    shape = _payload(corpus, payload, return_fields)
    sort = tuple(sort) or (Relevance(),)
    order, reads, ranked = sort_columns(corpus, sort)
    scored = ranked or with_score or min_score is not None

    # Rank on narrow rows and fetch texts for the page only, where the id allows it.
    wanted = {"value": list(return_fields[:1]), "doc": [], "doc_and_indexes": []}.get(payload, list(return_fields)) or corpus.df.columns
    has_text = bool(snippets) or bool(set(wanted) & set(corpus.text_fields))
    late = corpus.index is not None or (has_text and scored and corpus.unique_ids)
    if late:
        columns = reads
    else:
        columns = None if has_text else list(dict.fromkeys([*reads, *wanted]))
    rows = matching(corpus, query, scored=scored, columns=columns)
    if min_score is not None:
        rows = rows.where(F.col(SCORE) >= min_score)
    page = rows.orderBy(*order).limit(limit + offset)
    page = page.withColumn("__rank", F.row_number().over(W.orderBy(*order)))
    if offset:
        page = page.where(F.col("__rank") > offset)
    if late and (has_text or not set(wanted) <= set(reads)):
        page = _fetch(corpus, page.select(f"`{corpus.key()}`", "__rank", *([SCORE] if scored else [])), limit + offset)
    if snippets and limit + offset > ONE_TASK_PAGE:
        page = page.repartition("__rank")
    page = add_snippets(page, corpus, query, snippets)
    head = [F.col("__rank").alias("rank")]
    if corpus.id_col:
        head.append(corpus.id_text().alias("id"))
    if with_score:
        head.append(F.col(SCORE).alias("score"))
    taken = {"rank", "id", "score"}
    shape = [c for c in shape if payload in ("value", "json") or _name(c) not in taken]
    return page.orderBy("__rank").select(*head, *shape, *[s.column_name for s in snippets])


def _fetch(corpus: Corpus, page: DataFrame, size: int) -> DataFrame:
    """The rows of a ranked page of ids."""
    return corpus.df.join(F.broadcast(page) if size <= BROADCAST_PAGE else page, corpus.key())


def _name(column: Column) -> str:
    return column._jc.toString()


def matches(corpus: Corpus, query: Query | None = None, *, scored: bool = False,
            columns: Sequence[str] | None = None) -> DataFrame:
    """Every matching row, unranked, with a ``score`` column if asked for.

    Name the ``columns`` you need: leaving out the text saves a second analysis
    of it when scoring.
    """
    rows = matching(corpus, query, scored=scored, columns=None if columns is None else list(columns))
    return rows.withColumnRenamed(SCORE, "score") if scored else rows


def count(corpus: Corpus, query: Query | None = None) -> DataFrame:
    """Number of matching rows as a one-row DataFrame ``total``."""
    return matching(corpus, query, columns=[]).agg(F.count(F.lit(1)).alias("total"))


@dataclass
class Response:
    """Everything one search request can ask for; each part is a lazy DataFrame."""

    hits: DataFrame
    total: DataFrame | None = None
    facets: DataFrame | None = None


def respond(corpus: Corpus, query: Query | None = None, *, count_total: bool = False,
            facets: Sequence[Facet] = (), **options) -> Response:
    """A page of hits (see ``search``) with, if asked for, the exact total and facet counts of all matches."""
    return Response(
        search(corpus, query, **options),
        count(corpus, query) if count_total else None,
        facet_counts(corpus, facets, query) if facets else None,
    )
