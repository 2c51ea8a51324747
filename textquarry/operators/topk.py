"""The best rows of a full-text query without scoring every match.

Per block of rows the index bounds what each word can add to a score (``BlockIndex``). The blocks of the highest bounds
are scored first; the score of the last row wanted is then a threshold, and blocks that cannot reach it are never read.
The page equals that of ``search``: same scores, same order, ties by id.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce
from math import log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.functions.analysis import analyze_literals
from textquarry.operators.search import BROADCAST_PAGE
from textquarry.plans.scoring import bm25
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import TEXT
from textquarry.sources.impacts import BlockIndex

#: Up to this many stretches of neighbouring blocks go to the scan as a condition; more are joined.
INLINE_STRETCHES = 200
INLINE_BLOCKS = 5_000
#: Blocks scored for the threshold, at least: the best rows of several blocks stand higher than those of one.
SEEDS = 32
#: Pages beyond this rank score every match: their threshold would leave hardly a block out.
DEEPEST = 10_000
#: Bounds and scores add up in another order; this keeps a bound from falling below a score by rounding.
SLACK = 1e-9


@dataclass
class TopHits:
    """``hits`` (rank, the key, score) and what it reads: ``postings`` of the blocks left, out of ``matching`` postings."""

    hits: DataFrame
    postings: DataFrame
    matching: DataFrame


def _stretches(blocks: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b in sorted(blocks):
        if out and out[-1][1] == b - 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((b, b))
    return out


def _within(rows: DataFrame, blocks: list[int]) -> DataFrame:
    """Postings of the listed blocks, as a condition the scan can skip row groups and pages by."""
    if not blocks:
        return rows.where(F.lit(False))
    stretches = _stretches(blocks)
    if len(stretches) <= INLINE_STRETCHES:
        return rows.where(reduce(lambda a, b: a | b, [F.col("block").between(lo, hi) for lo, hi in stretches]))
    listed = rows.sparkSession.createDataFrame([(b,) for b in blocks], "block long")
    return rows.where(F.col("block").between(min(blocks), max(blocks))).join(F.broadcast(listed), "block", "left_semi")


def top_hits(corpus: Corpus, blocks: BlockIndex, text: str, *, field: str | None = None, limit: int = 10, offset: int = 0) -> TopHits:
    """Ranks ``offset + 1`` to ``offset + limit`` of the rows holding any word of ``text``, by BM25.

    ``corpus`` has the term index that ``blocks`` was built from. Three small jobs run on the table of blocks and the best of
    them; ``hits`` itself is not run. Collected on the driver: a row per word, ``offset + limit`` blocks, and at most
    ``INLINE_BLOCKS`` numbers of the blocks left (more of them are joined from their table).
    """
    if limit < 0 or offset < 0:
        raise RequestError("limit and offset must not be negative")
    if corpus.index is None:
        raise RequestError("top_hits needs a corpus with a term index")
    names = [field] if field else corpus.text_fields
    if len(names) != 1 or corpus.spec(names[0]).kind != TEXT:
        raise RequestError("top_hits needs one text field")
    name, key, k = names[0], corpus.key(), limit + offset
    [words] = analyze_literals(corpus.spark, [(text, corpus.spec(name).analyzer)])
    times = Counter(words)
    mine = lambda table: table.where((F.col("field") == name) & F.col("term").isin(list(times)))
    held = {r.term: r.df for r in mine(corpus.index.terms).collect()}
    totals = corpus.index.lengths.where(F.col("field") == name).first()
    matching = mine(blocks.ranked)
    if not held or not k:
        empty = matching.where(F.lit(False))
        return TopHits(empty.select(F.lit(0).alias("rank"), F.col("doc_id").alias(key), F.lit(0.0).alias("score")), empty, matching)
    average = F.lit(totals.total / totals.n)
    idfs = {t: log1p((totals.n - df + 0.5) / (df + 0.5)) for t, df in held.items()}

    def gain(term: str, tf: Column, dl: Column) -> Column:
        return F.when(F.col("term") == term, bm25(tf, dl, F.lit(idfs[term]), average))

    def scored(rows: DataFrame) -> DataFrame:
        """Rows by id with their scores, added up in the order of the words as a search adds them."""
        gains = [F.coalesce(F.max(gain(t, F.col("tf"), F.col("dl"))), F.lit(0.0)) for t in words if t in held]
        return rows.groupBy("doc_id").agg(reduce(lambda a, b: a + b, gains).alias("score"))

    read = matching
    if k <= DEEPEST:
        bound = reduce(lambda a, b: a + b, [F.coalesce(gain(t, F.col("most"), F.col("least")), F.lit(0.0)) * times[t] for t in held])
        bounds = mine(blocks.blocks).groupBy("block").agg((F.sum(bound) * (1 + SLACK)).alias("bound"), F.max("n").alias("n"))
        best, rows = [], 0
        for r in bounds.orderBy(F.desc("bound"), "block").limit(max(k, SEEDS)).collect():
            best.append(r.block)
            rows += r.n  # a block has at least as many matching rows as its commonest word
            if rows >= k and len(best) >= SEEDS:
                break
        first = scored(_within(matching, best)).orderBy(F.desc("score")).limit(k).agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("c")).first()
        threshold = first.s if first.c == k else 0.0
        left = bounds.where(F.col("bound") >= threshold).select("block")
        listed = [r.block for r in left.limit(INLINE_BLOCKS + 1).collect()]
        read = _within(matching, listed) if len(listed) <= INLINE_BLOCKS else matching.join(left, "block", "left_semi")
    order = [F.desc("score"), F.asc("doc_id")]
    page = scored(read).orderBy(*order).limit(k).withColumn("rank", F.row_number().over(W.orderBy(*order)))
    hits = page.where(F.col("rank") > offset).select("rank", F.col("doc_id").alias(key), "score")
    return TopHits(hits, read, matching)


def with_rows(corpus: Corpus, page: DataFrame, size: int) -> DataFrame:
    """The rows of a ranked page beside their ``rank`` and ``score``."""
    return corpus.df.join(F.broadcast(page) if size <= BROADCAST_PAGE else page, corpus.key()).orderBy("rank")
