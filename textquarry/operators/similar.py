"""Batch retrieval: many queries or many source rows against one corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.functions.analysis import token_slots
from textquarry.plans.frames import share
from textquarry.plans.features import STATS, Features, scan_base
from textquarry.plans.query import MoreLikeThis
from textquarry.plans.scoring import B, K1, bm25, idf
from textquarry.plans.terms import distinct_terms, term_rows
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import TEXT, literal
from textquarry.sources.postings import TermIndex
from textquarry.sources.scratch import scratch_path, written

#: A table of request terms with at most this many rows (some tens of MB) is broadcast.
BROADCAST_TERMS = 500_000
#: Otherwise both sides are shuffled, a frequent term being cut into this many parts.
SALTS = 16
#: A request whose terms stand in at most this many rows by its own limits has every pair scored: bounds would cost more.
DIRECT_PAIRS = 5_000
#: More requests than this share one pass over the postings, every pair scored, if they ask for each posting at most so often.
MANY_REQUESTS = 64
DIRECT_SHARE = 20
#: A request's rarest terms, until they have this many times ``k`` rows, set the score that its other rows must reach.
LEADING = 20
#: Bounds and scores add up in another order; this keeps a bound from falling below a score by rounding.
SLACK = 1e-9


def _corpus_stats(corpus: Corpus, fields: list[str]) -> DataFrame:
    """Row count and average field lengths as one struct."""
    features = Features(corpus)
    for f in fields:
        features.avg_length(f)
    if corpus.index is not None:
        totals = corpus.index.totals(features, corpus)
    else:
        totals = features.totals(features.scan_frame(scan_base(corpus, features)))
    pairs = [(f, features.length_stats[f]) for f in fields]
    return features.stats_struct(totals).select(
        F.struct(
            F.col(f"{STATS}.n").alias("n"),
            F.map_from_arrays(
                F.array(*[F.lit(f) for f, _ in pairs]),
                F.array(*[F.col(f"{STATS}.avg_{s}") for _, s in pairs]),
            ).alias("avg"),
        ).alias(STATS)
    )


def _rows(corpus: Corpus, fields: list[str], frequency: bool) -> DataFrame:
    """``doc_id, field, term, dl`` (and ``tf``) for the whole corpus, stored or derived."""
    columns = ["doc_id", "field", "term", "dl", *(["tf"] if frequency else [])]
    if corpus.index is not None:
        return corpus.index.postings.where(F.col("field").isin(fields)).select(*columns)
    return (term_rows if frequency else distinct_terms)(corpus, fields).select(*columns)


def _doc_freqs(corpus: Corpus, fields: list[str], few: DataFrame | None = None) -> DataFrame:
    """``field, term, df`` of every term, or of those in ``few`` (small enough to broadcast)."""
    if corpus.index is not None:
        counts = corpus.index.terms.where(F.col("field").isin(fields))
        return counts if few is None else counts.join(F.broadcast(few), ["field", "term"])
    rows = _rows(corpus, fields, False)
    if few is not None:  # narrow before counting, so only asked-for terms are shuffled
        rows = rows.join(F.broadcast(few), ["field", "term"])
    return rows.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def _statistics(corpus: Corpus, fields: list[str], few: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Corpus statistics and document frequencies; with ``few`` terms from one analysis of the corpus."""
    if corpus.index is not None or few is None:
        return _corpus_stats(corpus, fields), _doc_freqs(corpus, fields, few)
    found = distinct_terms(corpus, fields, markers=True).join(
        F.broadcast(few.withColumn("known", F.lit(True))), ["field", "term"], "left"
    )
    counts = share(
        found.where("known OR term IS NULL").groupBy("field", "term")
        .agg(F.count(F.lit(1)).alias("df"), F.sum("dl").alias("total"))
    )
    # The rows without a term, one per field, count the corpus and its lengths.
    stats = counts.where("term IS NULL").agg(F.struct(
        F.max("df").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("field", (F.col("total") / F.col("df")).alias("avg")))).alias("avg"),
    ).alias(STATS))
    return stats, counts.where("term IS NOT NULL").drop("total")


def _fits(rows: DataFrame, bound: int) -> bool:
    """Whether ``rows`` has at most ``bound`` rows; counting stops just above it."""
    return rows.limit(bound + 1).count() <= bound


def _gains(rows: DataFrame, asked: DataFrame, small: bool, frequency: bool, excluding_self: bool, salted: bool = True) -> DataFrame:
    """``query_id, doc_id, score`` of the (request, row) pairs that share one of the asked terms.

    Not ``salted``: no asked term is frequent, and the requests need not be repeated for the parts of one.
    """
    on = ["field", "term"]
    if small:
        pairs = rows.join(F.broadcast(asked), on)
    elif not salted:
        pairs = rows.join(asked, on)
    else:
        # A frequent term would land in one task; the row id splits it.
        pairs = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(
            asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*on, "salt"]
        )
    if excluding_self:
        pairs = pairs.where(F.col("query_id") != F.col("doc_id"))
    return pairs.groupBy("query_id", "doc_id").agg(F.sum(_gain(frequency)).alias("score"))


def _gain(frequency: bool):
    return F.col("weight") * bm25(F.col("tf") if frequency else F.lit(1), F.col("dl"), F.col("idf"), F.col("avg"))


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def _completed(rows: DataFrame, pairs: DataFrame, terms: DataFrame, small: bool, frequency: bool) -> DataFrame:
    """``pairs`` (``query_id, doc_id, score``) with the gains of their request's ``terms`` added, looked up row by row."""
    held = terms.groupBy("query_id").agg(F.collect_list(F.struct("field", "term", "idf", "avg", "weight")).alias("others"))
    asked = pairs.join(F.broadcast(held) if small else held, "query_id", "left")
    asked = asked.select("query_id", F.col("doc_id").alias("id_"), "score", F.explode_outer("others").alias("o"))
    asked = asked.select("query_id", "id_", "score", F.col("o.field").alias("field_"), F.col("o.term").alias("term_"), "o.idf", "o.avg", "o.weight")
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("field") == F.col("field_")) & (F.col("term") == F.col("term_"))
    found = asked.join(rows, same, "left").groupBy("query_id", F.col("id_").alias("doc_id"))
    return found.agg((F.max("score") + F.coalesce(F.sum(_gain(frequency)), F.lit(0.0))).alias("score"))


def split_terms(rows: DataFrame, asked: DataFrame, k: int, small: bool, frequency: bool, excluding_self: bool) -> DataFrame:
    """``asked`` with ``least`` (no row below it is among a request's best ``k``), ``upto`` and ``essential``.

    ``least`` is the lowest whole score of the ``k`` rows that the request's rarest terms favour. Terms of the smallest
    largest gains are not essential as long as all of them together (``upto``) stay below it: a row needs another term.
    """
    asked = _largest_gains(rows, asked, small, frequency)
    of_request = W.partitionBy("query_id")
    before = F.sum("df").over(of_request.orderBy("df", "field", "term").rowsBetween(W.unboundedPreceding, -1))
    leading = asked.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < LEADING * k)
    first = _ranked(_gains(rows, leading, small, frequency, excluding_self), k).select("query_id", "doc_id", F.lit(0.0).alias("score"))
    whole = _completed(rows, first, asked, small, frequency).groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s"))
    least = whole.where(F.col("c") == k).select("query_id", (F.col("s") * (1 - SLACK)).alias("least"))
    upto = F.sum("top").over(of_request.orderBy("top", "field", "term").rowsBetween(W.unboundedPreceding, W.currentRow))
    known = asked.withColumn("upto", upto * (1 + SLACK)).join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    return known.withColumn("essential", F.col("upto") >= F.col("least"))


def _largest_gains(rows: DataFrame, asked: DataFrame, small: bool, frequency: bool) -> DataFrame:
    """``asked`` with ``top``, no less than what its term adds to any row: exact for few requests, else from the formula."""
    if small:
        most = rows.join(F.broadcast(asked.select("field", "term", "idf", "avg").distinct().withColumn("weight", F.lit(1.0))), ["field", "term"])
        most = most.groupBy("field", "term").agg(F.max(_gain(frequency)).alias("most"))
        return asked.join(most, ["field", "term"]).withColumn("top", F.col("weight") * F.col("most")).drop("most")
    norm = F.lit(1.0 if frequency else 1 + K1 * (1 - B)) + F.lit(K1 * B) / F.col("avg")
    return asked.withColumn("top", F.col("weight") * F.col("idf") * F.lit(K1 + 1) / norm)


def _best_per_request(corpus: Corpus, fields: list[str], asked: DataFrame, stats: DataFrame, k: int, small: bool,
                      frequency: bool, excluding_self: bool, direct: bool = False, salted: bool = True) -> DataFrame:
    """Each request's best ``k`` rows among those that share a term with it.

    ``asked`` has ``query_id, field, term, df, idf, weight``. With an index, unless many requests share a pass, essential terms generate (request, row) pairs
    and the other, frequent ones are looked up for pairs that can still be among the best; scores are whole. Without one
    the analysis of the texts yields all terms of a row at once: every pair is scored, as it is where ``direct`` asks for it.
    """
    rows = _rows(corpus, fields, frequency)
    asked = asked.withColumn(STATS, stats.scalar()).withColumn("avg", F.col(STATS)["avg"][F.col("field")]).drop(STATS)
    if corpus.index is None or direct or k < 1:
        return _ranked(_gains(rows, asked, small, frequency, excluding_self, salted), k)
    asked = written(asked)
    if small and _shared_pass(corpus, fields, asked):
        return _ranked(_gains(rows, asked, small, frequency, excluding_self), k)
    parts = written(split_terms(rows, asked, k, small, frequency, excluding_self))
    return _ranked(candidates(rows, parts, small, frequency, excluding_self), k)


def _shared_pass(corpus: Corpus, fields: list[str], asked: DataFrame) -> bool:
    """Whether many requests make few pairs beside the postings: the bounds read those and the pairs several times over."""
    postings = corpus.index.terms.where(F.col("field").isin(fields)).agg(F.sum("df")).first()[0] or 0
    requests, pairs = asked.agg(F.count_distinct("query_id"), F.sum("df")).first()
    return requests > MANY_REQUESTS and pairs <= DIRECT_SHARE * postings


def candidates(rows: DataFrame, parts: DataFrame, small: bool, frequency: bool, excluding_self: bool) -> DataFrame:
    """Whole scores of the (request, row) pairs that essential terms generate and that can reach ``least``."""
    open_ = F.coalesce(F.max(F.when(~F.col("essential"), F.col("upto"))), F.lit(0.0))
    request = parts.groupBy("query_id").agg(F.max("least").alias("least"), open_.alias("open"))
    pairs = _gains(rows, parts.where("essential"), small, frequency, excluding_self)
    pairs = pairs.join(F.broadcast(request) if small else request, "query_id").where(F.col("score") + F.col("open") >= F.col("least"))
    return _completed(rows, pairs, parts.where(~F.col("essential")), small, frequency)


def search_many(corpus: Corpus, queries: DataFrame, k: int = 10, *, query_id: str = "query_id",
                text: str = "text", fields: list[str] | None = None) -> DataFrame:
    """Full text (any word) for a table of queries: ``query_id, doc_id, score, rank``."""
    fields = list(fields or corpus.text_fields)
    if not fields:
        raise RequestError("full text needs at least one text field")
    words = None
    for f in fields:
        spec = corpus.spec(f)
        if spec.kind != TEXT:
            raise RequestError(f"{f!r} is not a text field")
        part = queries.select(
            F.col(query_id).alias("query_id"), F.lit(f).alias("field"),
            F.explode(token_slots(F.col(text), spec.analyzer)).alias("term"),
        ).where(F.col("term").isNotNull())
        words = part if words is None else words.unionByName(part)
    small = _fits(words, BROADCAST_TERMS)
    wanted = words.groupBy("query_id", "field", "term").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    stats, freqs = _statistics(corpus, fields, wanted.select("field", "term").distinct() if small else None)
    asked = (
        wanted.join(freqs, ["field", "term"]).withColumn(STATS, stats.scalar())
        .select("query_id", "field", "term", "df", "weight", idf(F.col(STATS)["n"], F.col("df")).alias("idf"))
    )
    return _best_per_request(corpus, fields, asked, stats, k, small, frequency=True, excluding_self=False)


def _telling_terms(corpus: Corpus, fields: list[str], sources: DataFrame | None, like: MoreLikeThis,
                   stats: DataFrame | None, small: bool) -> DataFrame:
    """Per source row (None: every row) its terms of highest tf*idf: ``query_id, field, term, df, idf, weight``.

    ``stats`` may be left out for one source (``small``), whose terms are few.
    """
    own = term_rows(corpus, fields, df=sources) if sources is not None else _rows(corpus, fields, True)
    own = own.withColumnRenamed("doc_id", "query_id")
    if like.min_term_frequency is not None:
        own = own.where(F.col("tf") >= like.min_term_frequency)
    if like.min_word_length is not None:
        own = own.where(F.length("term") >= like.min_word_length)
    if like.max_word_length is not None:
        own = own.where(F.length("term") <= like.max_word_length)
    if like.stop_words:
        own = own.where(~F.col("term").isin(list(like.stop_words)))
    if small:
        stats, freqs = _statistics(corpus, fields, own.select("field", "term").distinct())
    else:
        freqs = _doc_freqs(corpus, fields)
    if like.min_doc_frequency is not None:
        freqs = freqs.where(F.col("df") >= like.min_doc_frequency)
    if like.max_doc_frequency is not None:
        freqs = freqs.where(F.col("df") <= like.max_doc_frequency)
    known = (
        own.join(freqs, ["field", "term"]).withColumn(STATS, stats.scalar())
        .withColumn("idf", idf(F.col(STATS)["n"], F.col("df")))
        .withColumn("telling", F.col("tf") * F.col("idf"))
    )
    if like.max_query_terms is not None:
        first = W.partitionBy("query_id").orderBy(F.desc("telling"), "field", "term")
        known = known.withColumn("pos", F.row_number().over(first)).where(F.col("pos") <= like.max_query_terms)
    if like.boost_factor is None:
        weight = F.lit(1.0)
    else:
        weight = F.col("telling") * like.boost_factor / F.max("telling").over(W.partitionBy("query_id"))
    return known.select("query_id", "field", "term", "df", "idf", weight.alias("weight"))


def _text_fields(corpus: Corpus) -> list[str]:
    if not corpus.text_fields:
        raise RequestError("more-like-this needs at least one text field")
    return corpus.text_fields


def more_like_this(corpus: Corpus, sources: DataFrame | None = None, k: int = 10,
                   like: MoreLikeThis | None = None) -> DataFrame:
    """Most similar rows for many sources at once: ``query_id, doc_id, score, rank``.

    ``sources`` is a DataFrame with the id column (None: every row of the
    corpus). ``like`` carries the term limits; its ``source_id`` is not used. On
    a large set of sources give a ``max_doc_frequency``: each source is compared
    with every row holding one of its terms, and that bound keeps the work
    proportional to the number of sources.
    """
    like = like or MoreLikeThis(None)
    fields = _text_fields(corpus)
    key = corpus.key()
    rows, indexed = None, corpus.index is not None
    if sources is not None:
        rows = corpus.df.join(sources.select(key), key, "left_semi")
    elif not indexed:  # frequencies, requests and rows all come from the terms of every row: they are analysed once
        corpus = corpus.with_index(TermIndex.gather(corpus, scratch_path(corpus.spark, "terms"), fields))
    stats = _corpus_stats(corpus, fields)
    # A source's own vocabulary has no fixed size, so it is never broadcast here;
    # the terms kept per source are limited, so with few sources those can be.
    asked = _telling_terms(corpus, fields, rows, like, stats, small=False)
    per_source, most = like.max_query_terms, like.max_doc_frequency
    bounded = bool(per_source) and _fits(
        (corpus.df if sources is None else sources).select(key), BROADCAST_TERMS // per_source
    )
    few = bool(per_source) and most is not None and per_source * most <= DIRECT_PAIRS
    # Weights below zero have no bounds, and over texts these were slower than scoring every pair.
    return _best_per_request(
        corpus, fields, asked, stats, k, bounded, frequency=False, excluding_self=like.exclude_source,
        direct=few or not indexed or (like.boost_factor or 0) < 0, salted=not few,
    )


def telling_terms(corpus: Corpus, like: MoreLikeThis) -> list[tuple[str, str, float | None]]:
    """The terms one source row is matched by; they become clauses of the query.

    Collected on the driver: at most the distinct terms of a single row.
    """
    fields = _text_fields(corpus)
    key = corpus.key()
    spec = corpus.spec(key)
    source = corpus.df.where(spec.any_value(lambda v: v == literal(spec, like.source_id)))
    source = source.orderBy(F.to_json(F.struct(*[f"`{c}`" for c in corpus.df.columns]))).limit(1)  # of several rows with that id always the same
    found = _telling_terms(corpus, fields, source, like, None, small=True)
    rows = sorted(found.collect(), key=lambda r: (-r.weight, r.field, r.term))
    if not rows and source.isEmpty():
        raise RequestError(f"more_like_this: no row with {key} = {like.source_id!r}")
    return [(r.field, r.term, None if like.boost_factor is None else r.weight) for r in rows]
