"""The index tables are written without a second reading of their input, whatever its size."""

import random

import pytest
from pyspark.sql import functions as F

import textquarry as q
from textquarry.operators.similar import more_like_this
from textquarry.plans import terms
from textquarry.sources import patterns
from textquarry.sources.impacts import BlockIndex
from textquarry.sources.patterns import Needed, PatternIndex, fuzzy_table
from textquarry.sources.postings import TermIndex


@pytest.fixture
def jobs(spark):
    """Runs something and says how many Spark jobs it took."""
    def run(name, action):
        spark.sparkContext.setJobGroup(name, name)
        try:
            action()
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    return run


@pytest.fixture
def watched(spark):
    """A corpus of 200 rows and how often one of its texts was read."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    rows = spark.createDataFrame([(k, f"w{k % 7} w{k} w{k % 7}") for k in range(200)], "id long, body string")
    return q.Corpus(rows.select("id", read.asNondeterministic()("body").alias("body")), "id", {"body": q.text()}, unique_ids=True), seen


def test_each_text_is_analysed_once(watched, tmp_path):
    corpus, seen = watched
    index = TermIndex.build(corpus, str(tmp_path / "i"))
    assert seen.value == 200
    assert index.terms.where("term = 'w3'").first().df == 29 and index.postings.where("tf = 3").count() == 7


def test_similar_rows_read_each_text_once(watched, tmp_path):
    """Over texts they are analysed once for frequencies, requests and rows; over an index not at all."""
    corpus, seen = watched
    like = q.MoreLikeThis(None, min_doc_frequency=1, max_doc_frequency=60, max_query_terms=5, min_word_length=1)
    found = lambda c: sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in more_like_this(c, k=3, like=like).collect())
    plain = found(corpus)
    assert seen.value == 200 and len(plain) == 600
    indexed = corpus.with_index(TermIndex.build(corpus, str(tmp_path / "i")))
    assert found(indexed) == plain and seen.value == 400


@pytest.mark.parametrize("most", [1 << 20, 5, 1])
def test_terms_with_positions(spark, monkeypatch, most):
    """However a batch is cut: tokens in their places, dropped ones as holes, rows without tokens left out."""
    monkeypatch.setattr(terms, "MOST_TOKENS", most)
    rows = [("a", "Of the of, the x"), ("b", None), ("c", ""), ("d", "x " + "y" * 40 + " x"), (None, "über ÜBER"), ("a", "z")]
    corpus = q.Corpus(spark.createDataFrame(rows, "id string, body string").coalesce(1), "id", {"body": q.text()})
    got = sorted((r.doc_id or "", r.term, r.tf, r.dl, r.positions) for r in terms.term_rows(corpus, ["body"], positions=True).collect())
    want = [("", "über", 2, 2, [0, 1]), ("a", "of", 2, 5, [0, 2]), ("a", "the", 2, 5, [1, 3]), ("a", "x", 1, 5, [4]), ("a", "z", 1, 1, [0]), ("d", "x", 2, 2, [0, 2])]
    assert got == want


def test_variants_of_long_terms(spark, tmp_path):
    """A term has at most 29 variants; near words beyond the beginning, at it and across it are still found."""
    pick, size = random.Random(5), patterns.PREFIX
    words = {"".join(pick.choice("abc") for _ in range(n)) for n in range(size - 3, size + 6) for _ in range(12)}
    far = ["".join(pick.choice("abcdefgh") for _ in range(30)) for _ in range(5)]
    table = spark.createDataFrame([("body", w, 1) for w in [*words, *far]], "field string, term string, df long")
    built = PatternIndex.build(table, str(tmp_path / "p"), tables=["deletions"])
    assert built.deletions.groupBy("term").count().agg(F.max("count")).first()[0] <= 1 + size + size * (size - 1) // 2
    asked = spark.createDataFrame([(w,) for w in sorted(words)[::3] + [w[1:] + "x" for w in far]], "word string")
    got = {(r.word, r.term): r.distance for r in fuzzy_table(built, asked, 2, field="body").collect()}
    pairs = asked.crossJoin(table.select("term")).withColumn("distance", F.levenshtein("word", "term")).where("distance <= 2")
    assert got == {(r.word, r.term): r.distance for r in pairs.collect()}
    assert built.grams is None and not built.answers(Needed(grams=("abc",)))


@pytest.fixture
def index(spark, tmp_path):
    rows = [(k, f"station{k % 9} w{k}") for k in range(50)]
    corpus = q.Corpus(spark.createDataFrame(rows, "id long, body string"), "id", {"body": q.text()}, unique_ids=True)
    return TermIndex.build(corpus, str(tmp_path / "i"))


def test_patterns_take_no_sample(index, tmp_path, jobs):
    """A range partitioning would read its input once more, in a job of its own."""
    n = jobs("patterns", lambda: PatternIndex.build(index.terms, str(tmp_path / "p")))
    assert n <= 4  # two tables written, two opened


def test_blocks_take_no_sample(index, tmp_path, jobs):
    n = jobs("blocks", lambda: BlockIndex.build(index, str(tmp_path / "b")))
    print("jobs", n)
    assert n <= 8
