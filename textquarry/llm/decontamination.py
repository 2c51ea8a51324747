"""Benchmark decontamination by a positional inverted index, with DataFrame functions alone.

Items are cut into windows of ``size`` words (a shorter item is one window). The index stores the postings (term,
document, place) of the training texts for the terms that a window is looked up by: the ``DEPTH`` terms of each window
that are rarest in the training texts. A window's lists are shifted by the terms' offsets and intersected, rarest first;
what is left is compared word for word with the text. With ``slop`` above zero the shifted lists may miss each other by
so many words, and the matches are those of proximity.

Defined cases: null texts have no words; items without words have no window; rows that share an item id are one item,
a null item id reads as the empty string; equal rows get equal rows; columns other than those named fall away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import doc_rows, stored, words

DEPTH = 3
BROADCAST_ROWS = 200_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, broadcast if it has at most ``limit`` rows; a larger one is left to shuffled joins."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def windows(items: DataFrame, size: int) -> DataFrame:
    """window (its words) and item_id (as string), without repetition."""
    held = items.select(F.coalesce(items["item_id"].cast("string"), F.lit("")).alias("item_id"), words(F.coalesce(items["text"].cast("string"), F.lit(""))).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))
    return held.where(F.size("w") > 0).select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")).distinct()


def tokens(rows: DataFrame) -> DataFrame:
    """doc_id, th, at, term; the end of each text is a null term whose place is the number of its words."""
    listed = F.concat(words(F.col("text")), F.array(F.lit(None).cast("string")))
    return rows.select("doc_id", "th", listed.alias("w")).select("doc_id", "th", F.posexplode("w").alias("at", "term"))


def lookup_terms(held: DataFrame, counts: DataFrame) -> DataFrame:
    """window, number, and the offset and term of each of its ``DEPTH`` rarest places (``rank`` 0 is the rarest)."""
    single = held.select("number", F.posexplode("window").alias("offset", "term"))
    ranked = single.join(counts, "term").groupBy("number").agg(F.array_sort(F.collect_list(F.struct("seen", "offset", "term"))).alias("places"))
    whole = held.select("number", "window").join(ranked, "number").where(F.size("places") == F.size("window"))
    return whole.select("number", F.posexplode(F.slice("places", 1, DEPTH)).alias("rank", "p")).select("number", "rank", "p.offset", "p.term")


def intersect(postings: DataFrame, looked: DataFrame, slop: int) -> DataFrame:
    """(doc_id, th, number, start): where the shifted lists of a window's rarest terms meet."""
    def shifted(rank: int) -> DataFrame:
        one = small(looked.where(F.col("rank") == rank).select("number", "offset", "term"))
        return postings.join(one, "term").select("doc_id", "th", "number", (F.col("at") - F.col("offset")).alias("start"))

    found = shifted(0)
    for rank in range(1, DEPTH):
        other = shifted(rank)
        if slop:
            other = other.withColumn("start", F.explode(F.sequence(F.col("start") - slop, F.col("start") + slop)))
        deep = looked.where(F.col("rank") == rank).select("number").distinct()
        ends = found.join(small(deep), "number", "left_anti")
        other = other.withColumnsRenamed({"doc_id": "id_", "th": "th_", "number": "number_", "start": "start_"})
        same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_")) & (F.col("number") == F.col("number_")) & (F.col("start") == F.col("start_"))
        found = found.join(other, same, "left_semi").unionByName(ends)
    return found


def occurrences(rows: DataFrame, items: DataFrame, size: int = 10, slop: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Text ends (doc_id, th, n_words, copies), places (doc_id, th, number, start) of windows, and items of windows."""
    owned = windows(items, size)
    held = stored(owned.select("window").distinct().withColumn("number", F.xxhash64("window")))
    terms = small(stored(held.select(F.explode("window").alias("term")).distinct()))
    counts = stored(tokens(rows).join(terms, "term").groupBy("term").agg(F.count("*").alias("seen")))
    looked = stored(lookup_terms(held, counts))
    wanted = looked.select("term").distinct().unionByName(looked.sparkSession.sql("SELECT CAST(NULL AS STRING) AS term"))
    wanted = small(stored(wanted.withColumnRenamed("term", "t")))
    postings = stored(tokens(rows).join(wanted, F.col("term").eqNullSafe(F.col("t"))).drop("t"))
    ends = postings.where("term IS NULL").groupBy("doc_id", "th").agg(F.max("at").cast("long").alias("n_words"), F.count("*").alias("copies"))
    places = intersect(postings.where("term IS NOT NULL"), looked, slop)
    return ends, places, owned.join(held, "window").select("number", "item_id", "window")


def exact_places(rows: DataFrame, places: DataFrame, owned: DataFrame) -> DataFrame:
    """The places whose words are the window's, with the window's length."""
    phrases = stored(owned.select("number", "window").distinct())
    longest = phrases.agg(F.max(F.size("window"))).first()[0] or 1
    asked = stored(places.where("start >= 0").groupBy("doc_id", "th").agg(F.collect_set(F.struct("number", "start")).alias("asked")))
    candidates = asked.agg(F.sum(F.size("asked"))).first()[0] or 0
    asked = asked.withColumnsRenamed({"doc_id": "id_", "th": "th_"})
    same_row = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_"))
    texts = rows.join(F.broadcast(asked) if candidates <= BROADCAST_ROWS else asked, same_row).dropDuplicates(["doc_id", "th"])
    found = texts.select("doc_id", "th", words(F.col("text")).alias("w"), "asked").select(
        "doc_id", "th", F.explode(F.transform("asked", lambda p: F.struct(p["number"].alias("number"), p["start"].alias("start"), F.slice("w", p["start"] + 1, longest).alias("here")))).alias("p"))
    right = found.select("doc_id", "th", "p.*").join(small(phrases), "number").where(F.slice("here", 1, F.size("window")) == F.col("window"))
    return right.select("doc_id", "th", "number", "start", F.size("window").alias("length"))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """Per row of ``docs``: doc_id, th, n_words, n_hit (words inside any occurrence), item_ids (sorted)."""
    rows = doc_rows(docs)
    ends, places, owned = occurrences(rows, items, size)
    exact = stored(exact_places(rows, places, owned))
    hit = exact.groupBy("doc_id", "th").agg(F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))))).cast("long").alias("n_hit"))
    named = exact.select("doc_id", "th", "number").distinct().join(owned.select("number", "item_id"), "number").groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    marks = hit.join(named, (hit["th"] == named["th"]) & hit["doc_id"].eqNullSafe(named["doc_id"])).select(hit["doc_id"].alias("id_"), hit["th"].alias("th_"), "n_hit", "item_ids")
    joined = ends.join(marks, (F.col("th") == F.col("th_")) & F.col("doc_id").eqNullSafe(F.col("id_")), "left")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def phrase_matches(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, item_id, start, length) of every exact occurrence of an item's window."""
    rows = doc_rows(docs)
    _, places, owned = occurrences(rows, items, size)
    return exact_places(rows, places, owned).join(owned.select("number", "item_id"), "number").select("doc_id", "item_id", "start", "length")


def near_places(rows: DataFrame, places: DataFrame, owned: DataFrame, slop: int) -> DataFrame:
    """The places where every word of the window stands at most ``slop`` words off its own place."""
    phrases = small(stored(owned.select("number", "window").distinct()))
    asked = places.join(phrases, "number").groupBy("doc_id", "th").agg(F.collect_set(F.struct("number", "start", "window")).alias("asked"))
    asked = asked.withColumnsRenamed({"doc_id": "id_", "th": "th_"})
    same_row = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("th") == F.col("th_"))
    # A candidate may start up to ``slop`` words before the text does, and look as far before that.
    before = F.array_repeat(F.lit(None).cast("string"), 2 * slop)
    texts = rows.join(asked, same_row).dropDuplicates(["doc_id", "th"]).select("doc_id", "th", F.concat(before, words(F.col("text"))).alias("w"), "asked")
    here = F.slice("w", F.col("p.start") + slop + 1, F.size("p.window") + 2 * slop)
    found = texts.select("doc_id", "th", "w", F.explode("asked").alias("p")).select("doc_id", "th", "p.*", here.alias("here"))
    stands = F.transform("window", lambda term, i: F.exists(F.slice("here", i + 1, 2 * slop + 1), lambda w: w.eqNullSafe(term)))
    return found.where(F.forall(stands, lambda x: x)).select("doc_id", "th", "number", "start")


def proximity_matches(docs: DataFrame, items: DataFrame, size: int = 10, slop: int = 3) -> DataFrame:
    """(doc_id, item_id, start): where an item's window stands with its words at most ``slop`` words off their places.

    Places are counted from the window's rarest word (of equally rare ones the first), which stands on its own.
    """
    rows = doc_rows(docs)
    _, places, owned = occurrences(rows, items, size, slop)
    near = near_places(rows, places.where(F.col("start") >= -slop).distinct(), owned, slop)
    return near.join(owned.select("number", "item_id"), "number").select("doc_id", "item_id", "start").distinct()


def _digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ","), 256)


def query(spark, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), _digest(F.col("item_ids")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
i AS (SELECT item_id, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k, w FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT item_id, w[k:k + 9] AS win, len(w[k:k + 9]) AS size FROM i),
s AS (SELECT DISTINCT size FROM n),
p AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, s WHERE len(w) >= size),
m AS (SELECT doc_id, item_id, k, n.size FROM (SELECT doc_id, k, size, w[k:k + size - 1] AS win FROM p) q JOIN n USING (win)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
