"""The query tree. Nodes are plain values; ``compiler`` turns them into columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any


class Query:
    """Base of all nodes."""


@dataclass(frozen=True)
class All(Query):
    """Every row, score 1."""


@dataclass(frozen=True)
class Nothing(Query):
    """No row."""


@dataclass(frozen=True)
class Term(Query):
    """One exact value; on analysed text, one exact token (not analysed again)."""

    field: str
    value: Any


@dataclass(frozen=True)
class Exact(Query):
    """``Term`` for string-valued fields."""

    field: str
    value: str


@dataclass(frozen=True)
class Range(Query):
    """Values between bounds. ``gt`` takes precedence over ``gte``, ``lt`` over ``lte``."""

    field: str
    gt: Any = None
    gte: Any = None
    lt: Any = None
    lte: Any = None


@dataclass(frozen=True)
class In(Query):
    """Any of a set of values: a list, or for large sets a DataFrame whose first column holds them."""

    field: str
    values: Any


@dataclass(frozen=True)
class StartsWith(Query):
    field: str
    value: str


@dataclass(frozen=True)
class EndsWith(Query):
    field: str
    value: str


@dataclass(frozen=True)
class Contains(Query):
    field: str
    value: str


@dataclass(frozen=True)
class Regex(Query):
    """Pattern over the whole term; anchors are implied and therefore rejected."""

    field: str
    pattern: str


@dataclass(frozen=True)
class Match(Query):
    """Full text: analyse ``text`` per field and look for its words.

    ``operator`` "or" needs one word, "and" needs all of them in one field.
    ``phrase`` asks for the words next to each other, up to ``slop`` gaps.
    No ``fields`` means every text field.
    """

    text: str
    fields: Sequence[str] = ()
    operator: str = "or"
    phrase: bool = False
    slop: int = 0


@dataclass(frozen=True)
class Phrase(Query):
    """Tokens in order, with at most ``slop`` positions skipped in total."""

    field: str
    terms: Sequence[str]
    slop: int = 0


@dataclass(frozen=True)
class PhrasePrefix(Query):
    """A phrase whose last token is a prefix.

    The prefix stands for the first ``max_expansions`` terms in dictionary
    order; ``None`` lifts the limit and saves the dictionary pass.
    """

    field: str
    terms: Sequence[str]
    max_expansions: int | None = None


@dataclass(frozen=True)
class Fuzzy(Query):
    """Terms within an edit distance (at most 2) of ``value``.

    ``prefix`` compares with the beginning of terms; ``transpositions`` counts
    swapping two neighbours as one edit.
    """

    field: str
    value: str
    distance: int = 0
    transpositions: bool = False
    prefix: bool = False


@dataclass(frozen=True)
class DrillDown(Query):
    """Facet values at or below ``path``; only at it with ``only_this_level``."""

    field: str
    path: Sequence[str] = ()
    only_this_level: bool = False


@dataclass(frozen=True)
class Bool(Query):
    """Boolean combination; the score is the sum over matching must, filter and should.

    ``filter_scores=False`` keeps filter clauses out of the score.
    """

    must: Sequence[Query] = ()
    should: Sequence[Query] = ()
    must_not: Sequence[Query] = ()
    filter: Sequence[Query] = ()
    min_should_match: int | None = None
    filter_scores: bool = True


@dataclass(frozen=True)
class Exists(Query):
    """At least one value in the field."""

    field: str


@dataclass(frozen=True)
class Boost(Query):
    """Score of ``inner`` times ``factor``."""

    inner: Query
    factor: float


@dataclass(frozen=True)
class DisjunctionMax(Query):
    """Best clause plus ``tie_breaker`` times the others."""

    disjuncts: Sequence[Query]
    tie_breaker: float = 0.0


@dataclass(frozen=True)
class ConstScore(Query):
    """Rows of ``inner``, all with the same score."""

    inner: Query
    score: float


@dataclass(frozen=True)
class MoreLikeThis(Query):
    """Rows sharing the most telling terms of one source row."""

    source_id: Any
    min_doc_frequency: int | None = 5
    max_doc_frequency: int | None = None
    min_term_frequency: int | None = 2
    max_query_terms: int | None = 25
    min_word_length: int | None = None
    max_word_length: int | None = None
    boost_factor: float | None = 1.0
    stop_words: Sequence[str] = field(default_factory=tuple)
    exclude_source: bool = True
