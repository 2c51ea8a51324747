"""Bucket aggregations from one pass against one pass each."""

import datetime as dt
import random

import pytest

import textquarry as q
from textquarry.errors import RequestError
from textquarry.operators.aggregate import Avg, Bucket, Cardinality, Count, DateHistogram, Histogram, Max, Percentiles, Ranges, Stats, Sum, Terms, aggregate, aggregate_together


@pytest.fixture(scope="module")
def corpus(spark):
    pick = random.Random(2)
    rows = [(k, pick.choice("abcdefgh") if k % 9 else None, pick.choice(["x", "y", None]), pick.choice([None, float("nan"), pick.uniform(-50, 120)]),
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=pick.randrange(900)) if k % 5 else None, [pick.choice("pq")], pick.randrange(40)) for k in range(3000)]
    df = spark.createDataFrame(rows, "id long, kind string, side string, price double, at timestamp, tags array<string>, n long").repartition(5)
    return q.Corpus(df, "id", {"kind": q.of_kind("string"), "side": q.of_kind("string"), "tags": q.of_kind("string")})


REQUESTS = [
    [Terms("kinds", "kind", size=3, sub=[Avg("mean", "n"), DateHistogram("days", "at", "5d", sub=[Terms("sides", "side", size=1, sub=[Sum("s", "n")])])]),
     Histogram("prices", "price", 25.0, sub=[Count("c", "n"), Stats("st", "n")]), Ranges("parts", "n", [Bucket(None, 10, "low"), Bucket(20, 30, "mid"), Bucket(100, 200, "none")])],
    [Histogram("prices", "price", 10.0, min_doc_count=0, sub=[Max("top", "n"), Histogram("inner", "n", 7.0, min_doc_count=0)])],
    [Ranges("parts", "price", [Bucket(None, 0, "a"), Bucket(0, None, "b")], sub=[Terms("kinds", "kind", size=2, sub=[Ranges("again", "n", [Bucket(5, 9, "z")])])])],
    [Terms("kinds", "kind", sub=[Cardinality("d", "n", exact=True), Histogram("h", "n", 20.0, sub=[Terms("t", "side")])])],
]


@pytest.mark.parametrize("aggs", REQUESTS)
@pytest.mark.parametrize("query", [None, q.Range("n", gte=10), q.Nothing()])
def test_levels_are_those_of_single_passes(corpus, aggs, query):
    got, want = aggregate_together(corpus, aggs, query), aggregate(corpus, aggs, query).buckets
    assert list(got) == list(want)
    for path in want:
        assert got[path].columns == want[path].columns, path
        assert sorted(map(repr, got[path].collect())) == sorted(map(repr, want[path].collect())), path


def test_one_scan_for_all_levels(corpus, tmp_path, spark):
    corpus.df.write.parquet(str(tmp_path / "t"))
    stored = corpus.with_df(spark.read.parquet(str(tmp_path / "t")))
    levels = aggregate_together(stored, REQUESTS[0])
    for frame in levels.values():
        assert frame.inputFiles() and not any(str(tmp_path) in f for f in frame.inputFiles())


def test_requests_that_need_their_own_pass(corpus):
    for bad in ([Terms("t", "tags")], [Ranges("r", "n", [Bucket(0, 10, "a"), Bucket(5, 20, "b")])], [Terms("k", "kind", sub=[Percentiles("p", "n", exact=True)])], [Avg("a", "n")],
                [Terms("k", "kind"), Terms("k", "side")]):
        with pytest.raises(RequestError):
            aggregate_together(corpus, bad)
    assert aggregate_together(corpus, []) == {}
