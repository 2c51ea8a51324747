"""Highlighted fragments for a page of hits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields as dataclass_fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.functions.analysis import (
    BLANK_BASED, BLANK_CHARS, STEMMING, WORD_BASED, WORD_CHARS, field_slots, surface_slots, token_slots,
)
from textquarry.functions.values import html_escape
from textquarry.plans.compiler import Compiler
from textquarry.plans.query import Query
from textquarry.plans.terms import bind
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import TEXT

OPEN, CLOSE = "\x01", "\x02"  # stand-ins for the tags while the text is escaped


@dataclass(frozen=True)
class Snippet:
    """A fragment of ``field`` of at most ``max_chars``, terms wrapped in tags."""

    field: str
    max_chars: int = 150
    pre_tag: str = "<b>"
    post_tag: str = "</b>"
    name: str | None = None

    @property
    def column_name(self) -> str:
        return self.name or f"snippet_{self.field}"


def highlighted_terms(corpus: Corpus, query: Query | None, field: str) -> list[str]:
    """The exact terms a query looks for in one field."""
    if query is None:
        return []
    compiler = Compiler(corpus)
    compiler.compile(query)
    found = [t for f, t in compiler.features.terms if f == field]
    for phrase in compiler.features.phrases:
        if phrase.field == field:
            found += phrase.terms[:-1] if phrase.prefix else phrase.terms
    return list(dict.fromkeys(found))


def add_snippets(page: DataFrame, corpus: Corpus, query: Query | None, snippets: Sequence[Snippet]) -> DataFrame:
    """One string column per snippet; empty where nothing in the field matched.

    ``page`` is any DataFrame with the text columns: a page of hits, or all matching rows.
    """
    for s in snippets:
        spec = corpus.spec(s.field)
        if spec.kind != TEXT:
            raise RequestError(f"snippets need a text field, {s.field!r} is {spec.kind}")
        page = _add_one(page, spec, s, highlighted_terms(corpus, query, s.field))
    return page


def _add_one(page: DataFrame, spec, s: Snippet, terms: list[str]) -> DataFrame:
    if not terms:
        return page.withColumn(s.column_name, F.lit(""))
    keep = page.columns
    text = F.array_join(spec.values(), "\n") if spec.multi else F.coalesce(spec.column, F.lit(""))
    df = bind(page, "__text", F.translate(text, OPEN + CLOSE, ""))
    text = F.col("__text")

    # The spellings in this very text whose analysed form is a query term.
    if spec.analyzer in WORD_BASED or spec.analyzer in BLANK_BASED:
        df = bind(df, "__surface", surface_slots(text, spec.analyzer))
        df = bind(df, "__terms", token_slots(text, spec.analyzer))
        hit = F.filter(
            F.arrays_zip(F.col("__surface").alias("s"), F.col("__terms").alias("t")),
            lambda e: e["t"].isin(terms),
        )
        cls = f"[{WORD_CHARS}]" if spec.analyzer in WORD_BASED else f"[^{BLANK_CHARS}]"
        df = bind(df, "__words", F.array_distinct(F.transform(hit, lambda e: e["s"])))
        quoted = F.transform(F.col("__words"), lambda w: F.regexp_replace(w, r"([^\p{L}\p{N}])", r"\\$1"))
        pattern = F.concat(F.lit(f"(?<!{cls})(?:"), F.array_join(quoted, "|"), F.lit(f")(?!{cls})"))
        found = F.size("__words") > 0
    else:  # the whole value is the token
        found = F.arrays_overlap(token_slots(text, spec.analyzer), F.array(*[F.lit(t) for t in terms]))
        pattern = F.lit("(?s)^.+$")
    df = bind(df, "__pattern", F.when(found, pattern))
    pattern = F.col("__pattern")

    # Offsets of all occurrences: running lengths of the pieces between them.
    df = bind(df, "__hits", F.when(pattern.isNotNull(), F.regexp_extract_all(text, pattern, F.lit(0))))
    df = bind(df, "__gaps", F.when(pattern.isNotNull(), F.split(text, pattern, -1)))
    steps = F.zip_with(
        F.slice(F.col("__gaps"), F.lit(1), F.size("__hits")), F.col("__hits"),
        lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("len")),
    )
    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<a:int,b:int>>").alias("spans"))
    walked = F.aggregate(
        steps, zero,
        lambda acc, e: F.struct(
            (acc["end"] + e["gap"] + e["len"]).alias("end"),
            F.array_append(
                acc["spans"],
                F.struct((acc["end"] + e["gap"]).alias("a"), (acc["end"] + e["gap"] + e["len"]).alias("b")),
            ).alias("spans"),
        ),
    )
    df = bind(df, "__spans", walked["spans"])
    spans, room = F.col("__spans"), F.lit(s.max_chars)

    # The window that starts at an occurrence and holds the most of them; earliest wins.
    scored = F.transform(
        spans,
        lambda w, i: F.struct(  # spans are in order and at least one character long
            F.size(F.filter(F.slice(spans, i + 1, room), lambda o: o["b"] <= w["a"] + room)).alias("n"),
            (-w["a"]).alias("at"),
        ),
    )
    df = bind(df, "__best", F.array_max(F.filter(scored, lambda w: w["n"] > 0)))
    first = -F.col("__best")["at"]
    last = F.array_max(F.transform(
        F.filter(spans, lambda o: (o["a"] >= first) & (o["b"] <= first + room)), lambda o: o["b"]
    ))
    # Spare room is shared between both sides, then words cut at an edge are dropped.
    df = bind(df, "__lead", F.greatest(first - F.floor((room - (last - first)) / 2), F.lit(0)).cast("int"))
    df = bind(df, "__from", F.col("__lead") + F.when(
        F.col("__lead") > 0,
        F.length(F.regexp_extract(F.substring(text, F.col("__lead"), first - F.col("__lead") + 1), r"^\S*\s*", 0)) - 1,
    ).otherwise(0))
    df = bind(df, "__begin", F.least(F.greatest(F.col("__from"), F.col("__lead")), first))
    raw = F.substring(text, F.col("__begin") + 1, room)
    reach = last - F.col("__begin")
    tail = F.regexp_replace(F.substring(raw, reach + 1, room), r"\s*\S*$", "")
    cut = F.length(text) > F.col("__begin") + room
    df = bind(df, "__fragment", F.when(cut, F.concat(F.left(raw, reach), tail)).otherwise(raw))
    marked = html_escape(F.regexp_replace(F.col("__fragment"), pattern, F.lit(f"{OPEN}$0{CLOSE}")))
    tagged = F.replace(F.replace(marked, F.lit(OPEN), F.lit(s.pre_tag)), F.lit(CLOSE), F.lit(s.post_tag))
    return df.withColumn(s.column_name, F.coalesce(tagged, F.lit(""))).select(
        *[f"`{c}`" for c in keep], f"`{s.column_name}`"
    )
