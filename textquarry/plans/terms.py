"""Token rows of a corpus, grouped per row without a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.functions.analysis import field_slots
from textquarry.sources.corpus import Corpus, spread

#: Tokens grouped at once, which bounds what a Python worker holds beside its batch.
MOST_TOKENS = 1 << 20


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that is computed exactly once per row.

    Catalyst merges projections and moves filters below them, which would run
    an expensive expression again at each use. A one-element explode yields the
    same row with the value as an attribute, and neither rule crosses it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def token_count(slots: Column) -> Column:
    """Tokens in a slot array, holes left out."""
    return F.size(F.array_compact(slots))


def _cut(slots: DataFrame) -> DataFrame:
    """``doc_id, term, tf, dl, positions`` of rows ``doc_id, slots``: tokens grouped by (row, term) within an Arrow batch.

    Lambdas over a sorted array of (term, position) do the same at several times the cost. A batch is cut where it has
    MOST_TOKENS tokens; a longer row stays whole.
    """
    most = MOST_TOKENS

    def cut(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            ends, lo = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)), 0
            while lo < len(ids):
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + most, "right")))
                part = lists.slice(lo, hi - lo)
                starts, words = np.append(before, ends[lo:hi]) - before, pc.list_flatten(part).dictionary_encode()
                owner = np.repeat(np.arange(hi - lo), np.diff(starts))
                code = pc.fill_null(words.indices, -1).to_numpy().astype(np.int64)
                held = np.flatnonzero(code >= 0)
                owner, code, place = owner[held], code[held], (held - starts[owner[held]]).astype(np.int32)
                key = owner * (len(words.dictionary) + 1) + code
                order = np.argsort(key, kind="stable")
                key = key[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                row, bounds = owner[order[first]], np.append(first, len(key)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(row + lo)), words.dictionary.take(pa.array(code[order[first]])),
                    pa.array(np.diff(bounds)), pa.array(np.bincount(owner, minlength=hi - lo)[row].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(place[order])),
                ], ["doc_id", "term", "tf", "dl", "positions"])
                lo = hi

    numbers = [T.StructField(n, T.IntegerType()) for n in ("tf", "dl")]
    schema = [T.StructField("doc_id", slots.schema["doc_id"].dataType), T.StructField("term", T.StringType()), *numbers, T.StructField("positions", T.ArrayType(T.IntegerType()))]
    return slots.mapInArrow(cut, T.StructType(schema))


def term_rows(corpus: Corpus, fields: list[str], df: DataFrame | None = None, positions: bool = False) -> DataFrame:
    """One row per (row id, field, distinct term): ``doc_id, field, term, tf, dl[, positions]``.

    Tokens are grouped inside the row's own array, so grouping by (row, term) costs no exchange: with positions in
    Arrow batches, without by sorting the array and cutting it where the term changes.
    """
    key = corpus.key()
    base = corpus.df if df is None else df
    base = spread(base.select(key, *[f for f in fields if f != key]), key)
    parts = []
    for name in fields:
        d = bind(base, "__slots", field_slots(corpus.spec(name))).select(
            F.col(f"`{key}`").alias("doc_id"), "__slots"
        )
        if positions:
            parts.append(_cut(d).select("doc_id", F.lit(name).alias("field"), "term", "tf", "dl", "positions"))
            continue
        d = bind(d, "__sorted", F.sort_array(F.array_compact("__slots")))
        term_at = lambda i: F.get(F.col("__sorted"), i)
        every = F.transform(F.col("__sorted"), lambda _, i: i)
        d = bind(d, "__cut", F.filter(every, lambda i: (i == 0) | (term_at(i) != term_at(i - 1))))
        size = F.size("__sorted")
        run = F.transform(
            F.col("__cut"),
            lambda s, j: F.struct(
                term_at(s).alias("term"),
                (F.coalesce(F.get(F.col("__cut"), j + 1), size) - s).alias("tf"),
            ),
        )
        d = d.select("doc_id", size.alias("dl"), F.inline(run))
        parts.append(d.select("doc_id", F.lit(name).alias("field"), "term", "tf", "dl"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_terms(corpus: Corpus, fields: list[str], markers: bool = False) -> DataFrame:
    """``doc_id, field, term, dl`` like ``term_rows`` but without frequencies, which saves the sort.

    ``markers`` adds one row without a term per (row id, field), to count rows and lengths by.
    """
    key = corpus.key()
    base = spread(corpus.df.select(key, *[f for f in fields if f != key]), key)
    out = None
    for name in fields:
        d = bind(base, "__slots", F.array_compact(field_slots(corpus.spec(name))))
        terms = F.array_distinct("__slots")
        part = d.select(
            F.col(f"`{key}`").alias("doc_id"), F.lit(name).alias("field"), F.size("__slots").alias("dl"),
            F.explode(F.array_append(terms, F.lit(None)) if markers else terms).alias("term"),
        )
        out = part if out is None else out.unionByName(part)
    return out
