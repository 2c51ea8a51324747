"""Batches over an index: terms that cannot decide alone are looked up, the results are those of scoring every pair."""

import random

import pytest
from pyspark.sql import functions as F

import textquarry as q
from textquarry.operators import similar
from textquarry.sources.postings import TermIndex

K = 5


@pytest.fixture(scope="module")
def corpus(spark):
    """A few words stand in most rows, many in a few; equal texts tie; a null and an empty text."""
    pick = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(["the", "of", *(words[min(399, int(pick.paretovariate(0.5)) - 1)] for _ in range(pick.randrange(4, 60)))])) for k in range(1200)]
    rows += [(2000 + k, "the w0 zeta") for k in range(12)] + [(3000, None), (3001, "")]
    return q.Corpus(spark.createDataFrame(rows, "id long, body string"), "id", {"body": q.text()}, unique_ids=True)


@pytest.fixture(scope="module")
def indexed(corpus, tmp_path_factory):
    return corpus.with_index(TermIndex.build(corpus, str(tmp_path_factory.mktemp("index") / "i")))


@pytest.fixture(scope="module")
def queries(spark):
    rows = ["the of w120", "the w0 w200 w201", "the the the of", "zeta the", "absent", "absent w300 of", "", None, "w0", "of w390 w390"]
    return spark.createDataFrame(list(enumerate(rows)), "query_id long, text string")


def shown(hits):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in hits.collect())


@pytest.mark.parametrize("bound", [similar.BROADCAST_TERMS, 0])
def test_search_many(corpus, indexed, queries, monkeypatch, bound):
    want = shown(similar.search_many(corpus, queries, k=K))
    monkeypatch.setattr(similar, "BROADCAST_TERMS", bound)
    assert {i for i, *_ in want} == {0, 1, 2, 3, 5, 8, 9}
    assert shown(similar.search_many(indexed, queries, k=K)) == want


@pytest.mark.parametrize("options", [{}, {"boost_factor": 2.0}, {"boost_factor": -1.0}, {"exclude_source": False, "max_query_terms": 4}])
def test_more_like_this(corpus, indexed, options):
    like = q.MoreLikeThis(None, min_term_frequency=1, min_doc_frequency=2, **options)
    sources = corpus.df.where("id % 40 = 0 OR id >= 2000")
    assert shown(similar.more_like_this(indexed, sources, K, like)) == shown(similar.more_like_this(corpus, sources, K, like))


def test_fewer_pairs_than_term_matches(indexed, queries, monkeypatch):
    """Of the pairs that share a term only a part is generated, and of these few are completed."""
    seen = {}
    inner = similar.candidates

    def counting(rows, parts, small, frequency, excluding_self):
        terms = parts.groupBy("query_id").agg(F.sum("df").alias("matches"), F.sum(F.when(F.col("essential"), F.col("df"))).alias("read"))
        seen.update({r.query_id: (r.matches, r.read) for r in terms.collect()})
        return inner(rows, parts, small, frequency, excluding_self)

    monkeypatch.setattr(similar, "candidates", counting)
    similar.search_many(indexed, queries, k=K).collect()
    print(seen)
    for query in (0, 3):  # a word of at least K rows beside common ones
        matches, read = seen[query]
        assert read < matches / 10, (query, matches, read)
    assert seen[9][0] == seen[9][1]  # its rare word has fewer rows than asked for: the common one decides too


def test_no_rows_and_no_queries(indexed, queries, spark):
    assert similar.search_many(indexed, queries.limit(0)).count() == 0
    assert similar.search_many(indexed, queries, k=0).count() == 0


def test_many_requests_share_a_pass(corpus, indexed, spark, monkeypatch):
    """Many requests are scored in one pass over the postings, with the results of a few."""
    rows = [(k, f"the w{k} w{k // 2} of") for k in range(similar.MANY_REQUESTS + 6)]
    many = spark.createDataFrame(rows, "query_id long, text string")
    want = shown(similar.search_many(corpus, many, k=K))
    monkeypatch.setattr(similar, "split_terms", None)
    assert shown(similar.search_many(indexed, many, k=K)) == want
