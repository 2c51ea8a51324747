"""License scans by diagonal voting, with DataFrame functions alone.

Templates are short licence phrases and notices. All rolling word pairs of a text are joined to the places of equal
pairs in the templates; each hit votes for the diagonal (place in the text minus place in the template). A phrase
stands where all its pairs vote for one diagonal. For notices, diagonals at most ``SLACK`` apart are merged, so words
that were put in or left out do not matter; a merged group counts when at least ``SHARE`` of the notice's pairs voted
and its span in the text is not longer than the notice by more than half. Hits compare the words too, not their hash
alone.

Defined cases: a null text has no words; equal rows get equal rows; other columns fall away. Votes are bits, so a
repeated vote changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from textquarry.llm.common import doc_rows, words

#: Fixed phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Notices, worded as licensors ask for them, and their labels.
NOTICES = [
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
]
SLACK = 2
SHARE = 0.6


def _templates() -> list[tuple]:
    """(template, at, first word, second word) for each pair of neighbouring words."""
    rows = []
    for number, (phrase, _) in enumerate(PHRASES + NOTICES):
        held = phrase.split()
        rows += [(number, at, a, b) for at, (a, b) in enumerate(zip(held, held[1:]))]
    return rows


_VALUES = ", ".join(f"({t}, {at}, '{a}', '{b}')" for t, at, a, b in _templates())


def _facts(template: Column) -> tuple[Column, Column, Column]:
    """Number of pairs, label and whether it is a phrase."""
    all_ = PHRASES + NOTICES
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), template + 1)
    return pick([len(p.split()) - 1 for p, _ in all_]), pick([label for _, label in all_]), template < len(PHRASES)


def pair_votes(rows: DataFrame) -> DataFrame:
    """One row per text (``template`` null, ``diagonal`` its number of words), and one per template and diagonal."""
    spark = rows.sparkSession
    held = words(F.col("text"))
    pair = lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1)).alias("hash"), w.alias("a"), F.get("words", i + 1).alias("b"))
    end = F.struct(F.lit(0).cast("long").alias("hash"), F.lit("").alias("a"), F.lit("").alias("b"))
    pairs = rows.select("doc_id", "th", held.alias("words")).select("doc_id", "th", F.posexplode(F.concat(F.transform("words", pair), F.array(end))).alias("at", "p"))
    table = spark.sql(f"SELECT * FROM VALUES {_VALUES}, (NULL, 0, '', '') AS t(template, place, a, b)")
    table = table.withColumn("hash", F.when(F.col("template").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("a", "b")))
    hits = pairs.join(F.broadcast(table), (F.col("p.hash") == table["hash"]) & (F.col("p.a") == table["a"]) & (F.col("p.b") == table["b"]))
    return hits.groupBy("doc_id", "th", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))).alias("votes"), F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("rows"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the phrases' places and labels, all labels, score and the spans found."""
    votes = pair_votes(doc_rows(docs))
    size, label, phrase = _facts(F.col("template"))
    by_place = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_place) > SLACK, F.lit(True)) | phrase | F.col("template").isNull()
    merged = (
        votes.withColumn("group", F.sum(apart.cast("int")).over(by_place)).groupBy("doc_id", "th", "template", "group")
        .agg(F.bit_or("votes").alias("votes"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("rows").alias("rows"))
    )
    share = F.bit_count("votes") / size
    spans = merged.select("doc_id", "th", "template", label.alias("label"), phrase.alias("phrase"), share.alias("share"), "low", "high", "rows", size.alias("size"))
    fits = F.col("phrase") & (F.col("share") == 1) | ~F.col("phrase") & (F.col("share") >= SHARE) & (F.col("high") - F.col("low") + 1 <= 1.5 * F.col("size"))
    base, text = F.col("phrase") & fits, F.col("template").isNull()
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    found = spans.groupBy("doc_id", "th").agg(
        F.max(F.when(text, F.col("low"))).cast("long").alias("n_words"), F.max(F.when(text, F.col("rows"))).alias("copies"),
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("low"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("low"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(fits).alias("labels"), F.coalesce(F.max(F.when(fits, F.col("share"))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_set(F.when(fits, F.struct("low", (F.col("high") + 2).alias("end"), "label", "share")))).alias("spans"),
    )
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies", "th")


def query(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


_FACTS = ", ".join(f"({n}, {len(p.split()) - 1}, '{label}', {n < len(PHRASES)})" for n, (p, label) in enumerate(PHRASES + NOTICES))
SQL = rf"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), p AS (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM w),
g AS (SELECT doc_id, i - 1 AS pos, words[i] AS a, words[i + 1] AS b FROM p),
t(template, place, a, b) AS (VALUES {_VALUES}),
f(template, size, label, phrase) AS (VALUES {_FACTS}),
v AS (
  SELECT doc_id, template, pos - place AS diagonal, bit_or(1::BIGINT << place) AS votes, min(pos) AS low, max(pos) AS high
  FROM g JOIN t USING (a, b) GROUP BY doc_id, template, pos - place
), n AS (
  SELECT *, phrase OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {SLACK}, true) AS apart FROM v JOIN f USING (template)
), k AS (SELECT *, sum(apart::INT) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS grp FROM n),
m AS (
  SELECT doc_id, template, label, phrase, size, bit_count(bit_or(votes)) / size AS share, min(low) AS low, max(high) AS high
  FROM k GROUP BY doc_id, template, label, phrase, size, grp
), s AS (SELECT * FROM m WHERE CASE WHEN phrase THEN share = 1 ELSE share >= {SHARE} AND high - low + 1 <= 1.5 * size END),
r AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(low) FILTER (phrase) AS first_word, max(low) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM s GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN r USING (doc_id)
"""
