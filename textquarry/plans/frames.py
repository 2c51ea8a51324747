"""From a query to a DataFrame of matching rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.plans.compiler import Compiler, Part
from textquarry.plans.features import STATS, Features, scan_base
from textquarry.plans.query import All, Query
from textquarry.sources.corpus import Corpus

SCORE = "__score"


def with_stats(df: DataFrame, corpus: Corpus, features: Features, frame: DataFrame | None = None) -> DataFrame:
    """Attach corpus statistics as a scalar subquery: one tiny row, computed once.

    ``frame`` holds the features of every row, if the caller has them already.
    """
    if not features.needs_stats:
        return df
    if corpus.index is not None:
        totals = corpus.index.totals(features, corpus)
    else:
        totals = features.totals(features.scan_frame(scan_base(corpus, features)) if frame is None else frame)
    return df.withColumn(STATS, features.stats_struct(totals).scalar())


def share(frame: DataFrame) -> DataFrame:
    """Put a shuffle under ``frame`` that several consumers in one query can reuse.

    Spark runs equal shuffles once, but consumers differ in the filters and
    columns they would push below it. Packing and unpacking the whole row above
    the shuffle keeps both there.
    """
    keys = [f"`{f.name}`" for f in frame.schema.fields if not isinstance(f.dataType, T.MapType)]
    shuffled = frame.repartition(*keys)
    return shuffled.select(F.explode(F.array(F.struct("*"))).alias("__row")).select("__row.*")


def feature_frame(corpus: Corpus, compiler: Compiler, part: Part, columns: list[str] | None) -> DataFrame:
    """The rows a match is decided on, with their feature columns.

    ``columns`` lists the corpus columns needed later (None: all of them).
    """
    features = compiler.features
    if corpus.index is None or not features.text_used:
        return features.scan_frame(scan_base(corpus, features))
    key = corpus.key()
    frame = corpus.index.frame(features).withColumnRenamed("doc_id", key)
    wanted = set(corpus.df.columns if columns is None else columns) | compiler.row_fields
    if part.needs_text and not wanted - {key} and not features.sets:
        return frame
    rows = features.attach_sets(corpus.df.select(key, *sorted(wanted - {key})))
    if part.needs_text:
        return rows.join(frame, key)
    missing = {n: 0 for n in [*features.terms.values(), *features.phrases.values(), *features.lengths.values()]}
    return rows.join(frame, key, "left").fillna(missing | {n: False for n in features.tests})


def scoring_frame(corpus: Corpus, compiler: Compiler, part: Part, columns: list[str] | None) -> DataFrame:
    """Rows with their features and the corpus statistics attached.

    Scoring needs statistics over all rows as well as the features of single
    ones. When no text has to be returned, the small feature rows of one
    analysis serve both; otherwise the text is analysed once for each.
    """
    features = compiler.features
    frame = feature_frame(corpus, compiler, part, columns)
    one_pass = (
        corpus.index is None and features.needs_stats and features.text_used
        and columns is not None and not set(columns) & set(corpus.text_fields)
    )
    if not one_pass:
        return with_stats(frame, corpus, features)
    kept = [c for c in corpus.df.columns if c in columns or c in compiler.row_fields or c == corpus.id_col]
    frame = share(frame.select(*[f"`{c}`" for c in kept], *features.names))
    return with_stats(frame, corpus, features, frame)


def matching(corpus: Corpus, query: Query | None, *, scored: bool = False,
             columns: list[str] | None = None) -> DataFrame:
    """Rows that match ``query``, plus a ``__score`` column if ``scored``."""
    compiler = Compiler(corpus)
    part = compiler.compile(query if query is not None else All())
    if scored:
        rows = scoring_frame(corpus, compiler, part, columns).where(part.match).withColumn(SCORE, part.score)
    else:
        rows = feature_frame(corpus, compiler, part, columns).where(part.match)
    shown = [f"`{c}`" for c in corpus.df.columns if c in rows.columns and (columns is None or c in columns)]
    return rows.select(*shown, *([SCORE] if scored else []))
