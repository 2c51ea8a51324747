"""Values, words and requests that once went wrong."""

import datetime as dt
import random

import pytest

from textquarry import Corpus, RequestError, of_kind, text
from textquarry.operators.aggregate import Bucket, DateHistogram, Histogram, Percentiles, Ranges, Terms, aggregate
from textquarry.operators.facets import Facet, facet_counts
from textquarry.operators.search import ByField, matches, search
from textquarry.operators.snippets import Snippet
from textquarry.plans.query import Bool, Fuzzy, Term
from textquarry.sources.maintain import delete, upsert
from textquarry.sources.postings import TermIndex


def test_nan_and_infinity_fall_into_no_bucket(spark):
    values = [1.0, 2.5, float("nan"), float("inf"), float("-inf"), 1e300, None, 7.0]
    corpus = Corpus(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double"), "id")
    found = aggregate(corpus, [Histogram("h", "v", 2.0)]).buckets["h"].collect()
    assert [(r.h, r[1]) for r in sorted(found, key=lambda r: r.h)] == [(0.0, 1), (2.0, 1), (4.0, 0), (6.0, 1)]
    for buckets, want in (([(None, 2.0), (2.0, None)], [2, 4]), ([(None, 3.0), (2.0, None)], [3, 4])):
        listed = [Bucket(low, high, f"b{k}") for k, (low, high) in enumerate(buckets)]
        rows = aggregate(corpus, [Ranges("r", "v", listed)]).buckets["r"].collect()
        assert [r["doc_count"] for r in sorted(rows, key=lambda r: r.r)] == want


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 10, 2, 30, 1, 250000)), (2, dt.datetime(1969, 12, 31, 23, 59, 59))], "id long, at timestamp_ntz")
    corpus = Corpus(df, "id")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = aggregate(corpus, [DateHistogram("d", "at", "1d", min_doc_count=1)]).buckets["d"].collect()
        assert sorted(r.d for r in rows) == [dt.datetime(1969, 12, 31), dt.datetime(2024, 3, 10)]
        shown = search(corpus, payload="json", return_fields=["at"], sort=[ByField("id")]).collect()
        assert [r.json for r in shown] == ['{"at":1710037801250}', '{"at":-1000}']
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_snippets_bear_any_word(spark):
    df = spark.createDataFrame([(1, r"x a\E(b [y a\E(b"), (2, "say c++ c++ now " * 40)], "id long, t string")
    corpus = Corpus(df, "id", {"t": text("whitespace")})
    found = search(corpus, Bool(should=[Term("t", r"a\e(b"), Term("t", "c++")]), snippets=[Snippet("t", 20)]).collect()
    assert {r.id: r.snippet_t for r in found}["1"] == r"x <b>a\E(b</b> [y <b>a\E(b</b>"
    assert {r.id: r.snippet_t for r in found}["2"].count("<b>c++</b>") >= 2


def test_ids_twice_in_an_upsert_are_an_error(spark):
    corpus = Corpus(spark.createDataFrame([(1, "a")], "id long, n string"), "id")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "id long, n string")
    with pytest.raises(Exception, match="twice"):
        upsert(corpus, twice).df.collect()
    assert [tuple(r) for r in upsert(corpus, twice.limit(1)).df.collect()] == [(1, "b")]


def test_a_corpus_does_not_overwrite_itself(spark, tmp_path):
    path = str(tmp_path / "c")
    corpus = Corpus(spark.createDataFrame([(1, "a"), (2, "b")], "id long, n string"), "id").save(path)
    with pytest.raises(RequestError):
        delete(corpus, [1]).save(path, mode="overwrite")
    assert corpus.df.count() == 2
    delete(corpus, [1]).save(str(tmp_path / "d"), mode="overwrite")


def test_fuzzy_takes_any_distance(spark):
    corpus = Corpus(spark.createDataFrame([(1, "thousand"), (2, "thoughts")], "id long, t string"), "id", {"t": text()})
    assert [r.id for r in matches(corpus, Fuzzy("t", "thousaxyz", 3)).collect()] == [1]
    with pytest.raises(RequestError):
        matches(corpus, Fuzzy("t", "thousaxyz", 3, transpositions=True))


def test_an_index_follows_appends_and_removals(spark, tmp_path):
    rows = [(1, "red fox"), (2, "red red dog"), (3, "blue fox"), (4, "fox fox"), (5, "cat")]
    corpus = lambda some: Corpus(spark.createDataFrame(some, "id long, t string"), "id", {"t": text()})
    query = Bool(should=[Term("t", "fox"), Term("t", "red")])
    scores = lambda c: sorted((r.id, round(r.score, 6)) for r in matches(c, query, scored=True, columns=["id"]).collect())
    index = TermIndex.build(corpus(rows[:3]), str(tmp_path / "a")).append(corpus(rows[3:]), str(tmp_path / "a"))
    assert scores(corpus(rows).with_index(index)) == scores(corpus(rows))
    gone = spark.createDataFrame([(2,), (4,)], "id long")
    left = corpus([r for r in rows if r[0] not in (2, 4)])
    assert scores(left.with_index(index.remove(gone, str(tmp_path / "b")))) == scores(left)


def test_facets_of_several_requests(spark):
    df = spark.createDataFrame([(1, ["/a/b/c", "/a/d"], "/x"), (2, ["/a/b"], "/y/z"), (3, None, None)], "id long, p array<string>, s string")
    corpus = Corpus(df, "id", {"p": of_kind("facet"), "s": of_kind("facet")})
    got = facet_counts(corpus, [Facet("p", ["a"], 1), Facet("s"), Facet("p", ["a", "b"])]).collect()
    assert [tuple(r) for r in got] == [(0, "p", "/a/b", 2, 3, 2), (1, "s", "/x", 1, 2, 2), (1, "s", "/y", 1, 2, 2), (2, "p", "/a/b/c", 1, 1, 1)]


def test_exact_percentiles(spark):
    pick = random.Random(5)
    values = [(k, pick.choice("ab"), float(pick.choice([pick.randrange(9), pick.randrange(100_000)]))) for k in range(3000)] + [(9000, "c", 4.0), (9001, "d", None)]
    corpus = Corpus(spark.createDataFrame(values, "id long, g string, v double"), "id")
    percents = [0.0, 1.0, 37.5, 50.0, 95.0, 99.9, 100.0]

    def want(held):
        held = sorted(held)
        at = [(len(held) - 1) * p / 100 for p in percents]
        return [held[int(x)] * (1 - x % 1) + held[min(int(x) + 1, len(held) - 1)] * (x % 1) for x in at]

    ask = Percentiles("p", "v", percents, exact=True)
    got = aggregate(corpus, [ask]).metrics.first().p
    assert [got[str(p)] for p in percents] == pytest.approx(want([v for _, _, v in values if v is not None]))
    rows = {r.t: r.p for r in aggregate(corpus, [Terms("t", "g", sub=[ask])]).buckets["t"].collect()}
    for g in "abc":
        assert [rows[g][str(p)] for p in percents] == pytest.approx(want([v for _, h, v in values if h == g]))
    assert rows["d"] is None
    assert aggregate(corpus, [ask], Term("g", "none")).metrics.first().p is None
