"""Small end-to-end scenarios, one per behaviour a caller relies on."""

import datetime as dt

import pytest

import textquarry as q
from textquarry import Corpus, RequestError, text
from textquarry.operators.aggregate import (
    Avg, Bucket, Concat, Count, DateHistogram, Max, Min, Percentiles, Ranges, Stats, Sum, Terms, aggregate,
)
from textquarry.operators.distinct import distinct_page, distinct_values, next_cursor
from textquarry.operators.explain import explain_scores
from textquarry.operators.facets import Facet, facet_counts
from textquarry.operators.search import ByField, IndexOrder, Relevance, count, search
from textquarry.operators.similar import more_like_this, search_many
from textquarry.operators.snippets import Snippet
from textquarry.sources import maintain
from textquarry.sources.fields import from_millis


def ids(df):
    return [r.id for r in df.collect()]


def total(corpus, query=None):
    return count(corpus, query).first().total


def named(spark, *names, analyzer="default"):
    rows = [(chr(97 + i), n) for i, n in enumerate(names)]
    return Corpus(spark.createDataFrame(rows, "id string, name string"), "id", {"name": text(analyzer)})


def test_count_all(people):
    assert total(people) == 3
    assert total(people, q.Nothing()) == 0


def test_term_and_range(people):
    assert ids(search(people, q.Term("id", "a"))) == ["a"]
    assert set(ids(search(people, q.Range("age", gte=28, lte=40)))) == {"a", "b"}
    assert ids(search(people, q.Range("age", gt=30, gte=1))) == ["b"]  # gt wins
    assert ids(search(people, q.Range("age", lt=30, lte=99))) == ["c"]


def test_term_on_text_is_a_raw_token(people):
    assert total(people, q.Term("name", "mira")) == 1
    assert total(people, q.Term("name", "Mira")) == 0
    assert total(people, q.Exact("name", "saltmarsh")) == 1


def test_sorting(people, spark):
    assert ids(search(people, sort=[ByField("age")])) == ["c", "a", "b"]
    assert ids(search(people, sort=[ByField("age", descending=True)])) == ["b", "a", "c"]
    up, down = (ids(search(people, sort=[IndexOrder(d)])) for d in (False, True))
    assert up == down[::-1]
    df = spark.createDataFrame([("a", 30), ("b", 40), ("c", 30)], "id string, age long")
    tied = Corpus(df, "id")
    assert ids(search(tied, sort=[ByField("age"), ByField("id", True)])) == ["c", "a", "b"]


def test_missing_values_sort_first_ascending_last_descending(spark):
    df = spark.createDataFrame([("a", None), ("b", 2), ("c", 1)], "id string, n long")
    c = Corpus(df, "id")
    assert ids(search(c, sort=[ByField("n")])) == ["a", "c", "b"]
    assert ids(search(c, sort=[ByField("n", True)])) == ["b", "c", "a"]


def test_paging_and_rank(people):
    page = search(people, sort=[ByField("age")], offset=1, limit=1).collect()
    assert [(r.rank, r.id) for r in page] == [(2, "a")]
    assert ids(search(people, limit=0)) == []
    assert ids(search(people, offset=9)) == []


def test_upsert_delete_truncate(spark):
    df = spark.createDataFrame([("a", "Mira", 30), ("b", "Tomas", 40)], "id string, name string, age long")
    c = Corpus(df, "id", {"name": text()})
    new = spark.createDataFrame([("a", "Alicia", 31, 1), ("a", "Alya", 32, 2)], "id string, name string, age long, at int")
    up = maintain.upsert(c, new, order_by="at")
    assert {(r.id, r.name) for r in up.df.collect()} == {("a", "Alya"), ("b", "Tomas")}
    assert total(maintain.delete(c, ["a"])) == 1
    assert total(maintain.delete(c, df.select("id"))) == 0
    assert total(maintain.truncate(c)) == 0
    assert total(maintain.append(c, df.select("id", "name"))) == 4
    other = spark.createDataFrame([("z", "Zed", 1, "b")], "id string, name string, age long, old string")
    assert {r.id for r in maintain.upsert(c, other, replaces="old").df.collect()} == {"a", "z"}
    with pytest.raises(q.FieldError):
        maintain.append(c, df.selectExpr("id", "name as age"))
    with pytest.raises(q.FieldError):
        maintain.append(c, df.selectExpr("id", "1L as other"))


def test_delete_by_query(people):
    gone = maintain.delete_where(people, q.Range("age", gte=30))
    assert gone.removed.first().removed == 2
    assert ids(search(gone.corpus)) == ["c"]


def test_reopen_needs_the_id_again(spark, tmp_path):
    df = spark.createDataFrame([("a", "Mira")], "id string, name string")
    Corpus.create(df, str(tmp_path / "c"), "id", {"name": text("simple")})
    again = Corpus.open(spark, str(tmp_path / "c"))
    assert again.spec("name").analyzer == "simple" and again.text_fields == ["name"]
    new = spark.createDataFrame([("a", "Alicia")], "id string, name string")
    with pytest.raises(q.FieldError):
        maintain.upsert(again, new)
    named_again = Corpus.create(df, str(tmp_path / "c"), "id")  # opens what is there
    assert total(maintain.upsert(named_again, new)) == 1


def test_metrics(spark):
    c = Corpus(spark.createDataFrame([("a", 30), ("b", 40), ("c", 20)], "id string, age long"), "id")
    aggs = [Sum("s", "age"), Avg("a", "age"), Min("lo", "age"), Max("hi", "age"), Count("n", "age"), Stats("st", "age")]
    r = aggregate(c, aggs).metrics.first()
    assert (r.s, r.a, r.lo, r.hi, r.n) == (90.0, 30.0, 20.0, 40.0, 3)
    assert r.st.asDict() == {"count": 3, "sum": 90.0, "min": 20.0, "max": 40.0, "avg": 30.0}
    e = aggregate(c, aggs, q.Nothing()).metrics.first()
    assert (e.s, e.a, e.lo, e.hi, e.n) == (0.0, 0.0, 0.0, 0.0, 0)
    n = aggregate(c, aggs, q.Nothing(), empty_as_null=True).metrics.first()
    assert n.a is None and n.st["min"] is None


def test_facets(people):
    rows = facet_counts(people, [Facet("category", ["people"])]).collect()
    assert [(r.label, r["count"]) for r in rows] == [("/people/staff", 2), ("/people/freelance", 1)]
    assert {(r.total_count, r.child_count) for r in rows} == {(3, 2)}
    top = facet_counts(people, [Facet("category"), Facet("category", ["people"], 1)]).collect()
    assert {(r.request, r.label, r["count"], r.total_count) for r in top} == {(0, "/people", 3, 3), (1, "/people/staff", 2, 3)}


def test_drill_down(people):
    assert total(people, q.DrillDown("category", ["people"])) == 3
    assert total(people, q.DrillDown("category", ["people", "staff"])) == 2
    assert total(people, q.DrillDown("category")) == 3
    assert total(people, q.DrillDown("category", ["people"], only_this_level=True)) == 0
    assert total(people, q.Term("category", "/people")) == 3
    assert total(people, q.DrillDown("category", ["peo"])) == 0


def test_full_text(people):
    assert ids(search(people, q.Match("SALTMARSH", ["name"]))) == ["a"]
    assert set(ids(search(people, q.Match("saltmarsh stone")))) == {"a", "c"}
    assert ids(search(people, q.Match("ines stone", operator="and"))) == ["c"]
    assert ids(search(people, q.Match("stone saltmarsh", operator="and"))) == []
    assert ids(search(people, q.Match("tomas the", phrase=True))) == ["b"]
    assert ids(search(people, q.Match("!!"))) == []


def test_date_histogram(spark):
    start, hour = 1704067200000, 3_600_000
    at = [start, start + hour, start + 25 * hour, start + 26 * hour, start + 27 * hour, start + 50 * hour]
    df = spark.createDataFrame([(str(i), from_millis(m)) for i, m in enumerate(at)], "id string, ts timestamp")
    days = aggregate(Corpus(df, "id"), [DateHistogram("d", "ts", "1d")]).buckets["d"].orderBy("d").collect()
    assert [r.doc_count for r in days] == [2, 3, 1]
    assert days[0].d == dt.datetime(2024, 1, 1)


def test_range_buckets_and_percentiles(spark):
    c = Corpus(spark.createDataFrame([(str(a), a) for a in (22, 35, 50, 65)], "id string, age long"), "id")
    got = aggregate(c, [Ranges("r", "age", [Bucket(None, 30.0), Bucket(30.0, 60.0, "mid"), Bucket(60.0)])])
    rows = {r.r: r.doc_count for r in got.buckets["r"].collect()}
    assert rows == {"*-30.0": 1, "mid": 2, "60.0-*": 1}
    ten = Corpus(spark.createDataFrame([(str(a), a) for a in range(1, 11)], "id string, age long"), "id")
    p = aggregate(ten, [Percentiles("p", "age", [50, 95]), Percentiles("x", "age", [50], exact=True)]).metrics.first()
    assert abs(p.p["50.0"] - 5.5) <= 1.5 and abs(p.p["95.0"] - 9.5) <= 1.5 and p.x == {"50.0": 5.5}


def test_sub_aggregation_and_concat(people, spark):
    c = Corpus(spark.createDataFrame([("a", 30), ("b", 40), ("c", 25), ("d", 35)], "id string, age long"), "id")
    rows = aggregate(c, [Terms("t", "age", sub=[Avg("mean", "age")])]).buckets["t"].collect()
    assert all(r.mean == float(r.t) for r in rows) and len(rows) == 4
    joined = aggregate(people, [Concat("all", "name", separator=" | "), Sum("s", "age")]).metrics
    assert joined.columns == ["all", "s"]
    assert set(joined.first()["all"].split(" | ")) == {"Mira Of Saltmarsh", "Tomas The Miller", "Ines Stone"}
    two = aggregate(people, [Concat("two", "age", max_docs=2)]).metrics.first().two
    assert two == "30, 40"
    with pytest.raises(RequestError):
        aggregate(people, [Terms("t", "id", sub=[Concat("x", "name")])])


def test_exists_and_fuzzy(spark):
    c = Corpus(spark.createDataFrame([("ab", 1), ("ac", 2), ("xyz", None)], "id string, age long"), "id")
    assert total(c, q.Exists("age")) == 2
    assert set(ids(search(c, q.Fuzzy("id", "ab", 1)))) == {"ab", "ac"}
    assert ids(search(c, q.Fuzzy("id", "ab"))) == ["ab"]
    assert total(c, q.Fuzzy("id", "ba", 1)) == 0
    assert total(c, q.Fuzzy("id", "ba", 1, transpositions=True)) == 1
    assert ids(search(c, q.Fuzzy("id", "x", 0, prefix=True))) == ["xyz"]


def test_phrase_prefix(people):
    assert ids(search(people, q.PhrasePrefix("name", ["mira", "of", "sal"]))) == ["a"]
    assert ids(search(people, q.PhrasePrefix("name", ["mil"]))) == ["b"]
    assert ids(search(people, q.PhrasePrefix("name", ["mira", "sal"], None))) == []
    assert ids(search(people, q.PhrasePrefix("name", []))) == []


def test_boost_dismax_const(spark):
    c = named(spark, "saltmarsh one", "saltmarsh two", "elsewhere")
    plain = search(c, q.Match("saltmarsh")).first().score
    boosted = search(c, q.Boost(q.Match("saltmarsh"), 5.0)).first().score
    assert abs(boosted - 5 * plain) < 1e-9
    both = q.DisjunctionMax([q.Match("saltmarsh"), q.Match("elsewhere")])
    assert len(ids(search(c, both))) == 3
    assert [r.score for r in search(c, q.ConstScore(q.Match("saltmarsh"), 7.5)).collect()] == [7.5, 7.5]
    tie = q.DisjunctionMax([q.ConstScore(q.All(), 2.0), q.ConstScore(q.All(), 4.0)], 0.5)
    assert search(c, tie).first().score == 5.0
    assert ids(search(c, q.DisjunctionMax([]))) == []


def test_snippet(spark):
    c = named(spark, "mira rowed across a narrow river mouth into saltmarsh", "nothing here")
    s = Snippet("name", pre_tag="[[", post_tag="]]")
    rows = {r.id: r.snippet_name for r in search(c, q.Bool(should=[q.Match("river"), q.All()]), snippets=[s]).collect()}
    assert "[[river]]" in rows["a"] and rows["b"] == ""


def test_explain(spark):
    c = named(spark, "mira of saltmarsh", "tomas")
    rows = explain_scores(c, q.Match("mira saltmarsh"), ["a", "zz"]).collect()
    root = next(r for r in rows if r.path == "0")
    assert root.matched and {r.doc_id for r in rows} == {"a"}
    leaves = [r for r in rows if r.term]
    assert abs(sum(r.contribution for r in leaves) - root.contribution) < 1e-9
    assert abs(root.contribution - search(c, q.Match("mira saltmarsh")).first().score) < 1e-9


def test_more_like_this(spark):
    c = named(spark, "tides maps coastal sailing", "tides maps coastal sailing harbours", "cooking recipes")
    like = q.MoreLikeThis("a", min_doc_frequency=1, min_term_frequency=1)
    assert ids(search(c, like)) == ["b"]
    keep = q.MoreLikeThis("a", min_doc_frequency=1, min_term_frequency=1, exclude_source=False)
    assert set(ids(search(c, keep))) == {"a", "b"}
    batch = more_like_this(c, k=3, like=like).collect()
    assert {(r.query_id, r.doc_id) for r in batch} == {("a", "b"), ("b", "a")}
    one = search(c, like).first()
    assert abs(next(r.score for r in batch if r.query_id == "a") - one.score) < 1e-9
    with pytest.raises(RequestError):
        search(c, q.MoreLikeThis("nope"))


def test_search_many_equals_single_searches(spark):
    c = named(spark, "red apple", "green apple tree", "red red wine", "plain water")
    queries = spark.createDataFrame([(1, "red apple"), (2, "tree wine"), (3, "absent")], "query_id long, text string")
    got = search_many(c, queries, k=5).collect()
    for qid, words in ((1, "red apple"), (2, "tree wine"), (3, "absent")):
        want = [(r.rank, r.id, round(r.score, 9)) for r in search(c, q.Match(words)).collect()]
        assert sorted((r.rank, r.doc_id, round(r.score, 9)) for r in got if r.query_id == qid) == want


def test_tokenizer_keeps_case(spark):
    c = named(spark, "FooBar Quux", analyzer="whitespace_raw")
    assert total(c, q.Term("name", "foobar")) == 0
    assert total(c, q.Term("name", "FooBar")) == 1


def test_distinct_paging(spark):
    c = Corpus(spark.createDataFrame([(f"k{i}",) for i in (3, 1, 7, 2, 5, 4, 6, 1)], "k string"))
    seen, cursor = [], None
    while True:
        page = distinct_page(c, "k", 3, cursor).collect()
        seen += [r.value for r in page]
        cursor = next_cursor(page, 3)
        if cursor is None:
            break
    assert seen == [f"k{i}" for i in range(1, 8)]
    assert distinct_values(c, "k").count() == 7
    with pytest.raises(RequestError):
        distinct_page(c, "k", 0)


def test_min_score_filters_before_paging(spark):
    c = named(spark, "apple", "apple apple pear", "pear")
    scores = [r.score for r in search(c, q.Match("apple")).collect()]
    assert len(ids(search(c, q.Match("apple"), min_score=scores[0], limit=2))) == 1
    by_id = search(c, q.Match("apple"), sort=[ByField("id")], min_score=0.01).collect()
    assert [r.id for r in by_id] == ["a", "b"] and all(r.score > 0 for r in by_id)
    assert ids(search(c, q.Match("apple"), sort=[Relevance(False)])) == ids(search(c, q.Match("apple")))[::-1]
