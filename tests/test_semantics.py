"""Rules that the small scenarios do not reach: boolean corner cases, phrases, types, payloads, equivalences."""

import datetime as dt
import json
import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import textquarry as q
from textquarry import Corpus, RequestError, of_kind, text
from textquarry.operators.aggregate import (
    Avg, Bucket, Cardinality, Count, DateHistogram, Histogram, Max, Min, Percentiles, Ranges, Stats, Sum, Terms, aggregate,
)
from textquarry.operators.distinct import distinct_page, distinct_values
from textquarry.operators.explain import explain_scores
from textquarry.operators.search import ByField, count, matches, search
from textquarry.operators.similar import more_like_this, search_many
from textquarry.operators.snippets import Snippet
from textquarry.sources.postings import TermIndex

LINES = [
    ("a", "the quick brown fox jumps over the lazy dog", 3, ["x", "y"]),
    ("b", "the brown quick fox", 5, ["y"]),
    ("c", "a lazy dog sleeps; the dog dreams of the fox", None, []),
    ("d", "Quick quick QUICK brown", 8, None),
    ("e", None, 1, ["z", "x"]),
    ("f", "", 2, ["x"]),
]


@pytest.fixture(scope="module")
def lines(spark):
    df = spark.createDataFrame(LINES, "id string, body string, n long, tags array<string>")
    return Corpus(df, "id", {"body": text()}, unique_ids=True)


@pytest.fixture(scope="module")
def indexed(lines, tmp_path_factory):
    return lines.with_index(TermIndex.build(lines, str(tmp_path_factory.mktemp("index") / "i")))


def found(corpus, query):
    return "".join(sorted(r.id for r in matches(corpus, query).collect()))


def M(word):
    return q.Match(word)


BOOLS = [
    (q.Bool(), "abcdef"),
    (q.Bool(must=[M("fox")]), "abc"),
    (q.Bool(must=[M("fox")], must_not=[M("dog")]), "b"),
    (q.Bool(must_not=[M("dog")]), ""),
    (q.Bool(must=[q.All()], must_not=[M("dog")]), "bdef"),
    (q.Bool(should=[M("fox"), M("dreams")], min_should_match=0), "abc"),
    (q.Bool(should=[M("fox"), M("dreams")], min_should_match=2), "c"),
    (q.Bool(should=[M("fox"), M("dreams")], min_should_match=3), ""),
    (q.Bool(must=[M("quick")], should=[M("fox")]), "abd"),
    (q.Bool(must=[M("quick")], should=[M("fox"), M("lazy")], min_should_match=1), "ab"),
    (q.Bool(filter=[q.Range("n", gte=3)], should=[M("fox")]), "abd"),
    (q.Bool(must_not=[q.Term("tags", "x")], must=[q.All()]), "bcd"),
]


@pytest.mark.parametrize("i", range(len(BOOLS)))
def test_bool_rules(lines, indexed, i):
    query, want = BOOLS[i]
    assert found(lines, query) == want
    assert found(indexed, query) == want


PHRASES = [
    (q.Phrase("body", ["quick", "brown"]), "ad"),
    (q.Phrase("body", ["brown", "quick"]), "b"),
    (q.Phrase("body", ["quick", "fox"]), "b"),
    (q.Phrase("body", ["quick", "fox"], slop=1), "ab"),
    (q.Phrase("body", ["the", "fox"], slop=2), "abc"),
    (q.Phrase("body", ["the", "quick", "fox"], slop=1), "ab"),
    (q.Phrase("body", ["quick", "quick", "quick"]), "d"),
    (q.Phrase("body", ["lazy", "quick"], slop=5), ""),
    (q.Phrase("body", []), ""),
    (q.PhrasePrefix("body", ["lazy", "d"]), "ac"),
    (q.PhrasePrefix("body", ["the", "f"], None), "c"),
    (q.PhrasePrefix("body", ["the", "d"], max_expansions=1), "c"),  # "dog" comes first in the dictionary
    (q.PhrasePrefix("body", ["dog", "d"], max_expansions=1), ""),  # "dreams" is beyond the first expansion
    (q.Match("quick brown", phrase=True), "ad"),
]


@pytest.mark.parametrize("i", range(len(PHRASES)))
def test_phrases(lines, indexed, i):
    query, want = PHRASES[i]
    assert found(lines, query) == want
    assert found(indexed, query) == want


TOKEN_TESTS = [
    (q.StartsWith("body", "qui"), "abd"), (q.StartsWith("body", "Qui"), ""), (q.StartsWith("id", "a"), "a"),
    (q.EndsWith("body", "eams"), "c"), (q.Contains("body", "ump"), "a"), (q.Contains("body", "k b"), ""),
    (q.Regex("body", "d.g"), "ac"), (q.Regex("body", "d."), ""), (q.Regex("body", "fox|lazy"), "abc"),
    (q.Range("body", gte="sleeps", lt="sleeqs"), "c"), (q.In("body", ["jumps", "dreams"]), "ac"), (q.In("body", []), ""),
    (q.In("tags", ["y", "z"]), "abe"), (q.Term("tags", "x"), "aef"), (q.Exists("tags"), "abef"), (q.Exists("n"), "abdef"),
    (q.Range("tags", gt="x"), "abe"), (q.StartsWith("tags", "z"), "e"), (q.Fuzzy("body", "quikc", 1), ""),
    (q.Fuzzy("body", "quikc", 1, transpositions=True), "abd"), (q.Fuzzy("body", "quikc", 2), "abd"),
    (q.Fuzzy("body", "quikc", 99), "abcd"), (q.Fuzzy("body", "slepe", 1, prefix=True), "c"), (q.Exists("body"), "abcdf"),
]


@pytest.mark.parametrize("i", range(len(TOKEN_TESTS)))
def test_token_predicates(lines, indexed, i):
    query, want = TOKEN_TESTS[i]
    assert found(lines, query) == want
    assert found(indexed, query) == want


def _scores(corpus, query):
    return {r.id: round(r.score, 10) for r in matches(corpus, query, scored=True, columns=["id"]).collect()}


SCORED = [
    M("quick fox"), q.Term("body", "quick"), q.Phrase("body", ["quick", "brown"]), q.Phrase("body", ["the", "fox"], 2),
    q.PhrasePrefix("body", ["lazy", "do"]), q.Boost(M("fox"), 3.0), q.DisjunctionMax([M("fox"), M("lazy dog")], 0.2),
    q.Bool(must=[M("the")], should=[q.Range("n", gte=4)], filter=[q.Exists("n")]),
    q.Bool(should=[M("fox"), q.Term("tags", "x"), q.Term("n", 8)]), q.ConstScore(q.Regex("body", "d.*"), 2.0),
    q.Bool(must=[M("quick")], must_not=[q.Term("id", "d")]),
]


@pytest.mark.parametrize("i", range(len(SCORED)))
def test_index_and_scan_agree_and_explain_adds_up(lines, indexed, i):
    query = SCORED[i]
    scan = _scores(lines, query)
    assert scan and scan == _scores(indexed, query)
    two_pass = {r.id: round(r.score, 10) for r in matches(lines, query, scored=True).collect()}
    assert two_pass == scan
    roots = explain_scores(lines, query, lines.df.select("id")).where("path = '0'").collect()
    assert {r.doc_id: round(r.contribution, 10) for r in roots if r.matched} == scan
    roots = explain_scores(indexed, query, list(scan)).where("path = '0'").collect()
    assert {r.doc_id: round(r.contribution, 10) for r in roots} == scan
    hits = search(indexed, query, limit=10, payload="materialized", return_fields=["body", "n"]).collect()
    plain = search(lines, query, limit=10, payload="materialized", return_fields=["body", "n"]).collect()
    assert [(h.rank, h.id, h.body, h.n) for h in hits] == [(h.rank, h.id, h.body, h.n) for h in plain]


def test_set_from_a_table(lines, indexed, spark):
    wanted = spark.createDataFrame([("a",), ("a",), ("e",), (None,)], "v string")
    assert found(lines, q.In("id", wanted)) == "ae"
    for corpus in (lines, indexed):
        assert found(corpus, q.Bool(must=[M("fox")], filter=[q.In("id", wanted)])) == "a"
        assert found(corpus, q.Bool(must=[M("fox")], must_not=[q.In("id", wanted)])) == "bc"
        assert list(_scores(corpus, q.Bool(must=[M("fox"), q.In("id", wanted)]))) == ["a"]
    with pytest.raises(q.LiteralError):
        found(lines, q.In("n", wanted))
    with pytest.raises(RequestError):
        found(lines, q.In("body", wanted))


def test_response(people):
    from textquarry.operators.facets import Facet
    from textquarry.operators.search import respond

    r = respond(people, q.Range("age", gte=30), limit=1, count_total=True, facets=[Facet("category")])
    assert (r.hits.count(), r.total.first().total, r.facets.first()["count"]) == (1, 2, 2)
    bare = respond(people)
    assert bare.total is None and bare.facets is None


def test_bm25_by_hand(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", "x x x z"), ("c", "y")], "id string, t string")
    got = _scores(Corpus(df, "id", {"t": text()}), M("x"))
    n, freq, avg = 3, 2, 7 / 3
    idf = math.log(1 + (n - freq + 0.5) / (freq + 0.5))
    want = {i: idf * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avg)) for i, tf, dl in (("a", 1, 2), ("b", 3, 4))}
    assert got == {k: round(v, 10) for k, v in want.items()}


def test_several_fields_and_default_fields(spark):
    df = spark.createDataFrame([("a", "red", "car"), ("b", "car", "blue"), ("c", "x", "y")], "id string, t string, u string")
    c = Corpus(df, "id", {"t": text(), "u": text("whitespace")})
    assert found(c, M("car")) == "ab"
    assert found(c, q.Match("car", ["u"])) == "a"
    assert found(c, q.Match("red car", operator="and")) == ""
    with pytest.raises(RequestError):
        matches(Corpus(df, "id"), M("car"))


def test_multi_valued_text_does_not_join_values(spark):
    df = spark.createDataFrame([("a", ["one two", "three"]), ("b", ["two three"]), ("c", None)], "id string, t array<string>")
    c = Corpus(df, "id", {"t": text()})
    assert found(c, q.Phrase("t", ["two", "three"])) == "b"
    assert found(c, q.Term("t", "three")) == "ab"
    stem = Corpus(df, "id", {"t": text("english_stem")})
    assert found(stem, q.Match("threes")) == "ab"


def test_stemmed_search_and_snippet(spark):
    df = spark.createDataFrame([("a", "He was running <fast>"), ("b", "A walk")], "id string, t string")
    c = Corpus(df, "id", {"t": text("english_stem")}, unique_ids=True)
    hit = search(c, q.Match("runs"), snippets=[Snippet("t")]).first()
    assert hit.id == "a" and hit.snippet_t == "He was <b>running</b> &lt;fast&gt;"


def test_snippet_window(spark):
    body = "filler " * 60 + "needle in a hay stack " + "padding " * 60 + "needle"
    df = spark.createDataFrame([("a", body)], "id string, t string")
    c = Corpus(df, "id", {"t": text()})
    frag = search(c, q.Match("needle stack"), snippets=[Snippet("t", 60, "<", ">", name="f")]).first().f
    plain = frag.replace("<", "").replace(">", "")
    assert len(plain) <= 60 and plain in body and "<needle>" in frag and "<stack>" in frag
    assert not plain.startswith("iller") and plain.split()[0] in ("filler", "needle")
    small = search(c, q.Match("needle"), snippets=[Snippet("t", 3, name="f")]).first().f
    assert small == ""  # no room for the term


def test_payload_modes(spark):
    df = spark.createDataFrame(
        [("a", ["x"], bytearray(b"\x01\xff"), dt.datetime(1970, 1, 1, 0, 0, 1), 2.5, '{"k": [1]}'), ("b", ["x", "y"], None, None, None, None)],
        "id string, tags array<string>, raw binary, at timestamp, f double, j string",
    )
    c = Corpus(df, "id", {"j": of_kind("json")})
    rows = search(c, sort=[ByField("id")], payload="json", with_score=False).collect()
    assert json.loads(rows[0].json) == {"id": "a", "tags": "x", "raw": "01ff", "at": 1000, "f": 2.5, "j": {"k": [1]}}
    assert json.loads(rows[1].json) == {"id": "b", "tags": ["x", "y"]}
    assert [r.value for r in search(c, sort=[ByField("id")], payload="value", return_fields=["tags"]).collect()] == ["x", "x"]
    assert search(c, payload="materialized", return_fields=["f"]).columns == ["rank", "id", "score", "f"]
    assert search(c).columns == ["rank", "id", "score", "tags", "raw", "at", "f", "j"]
    by_raw = Corpus(df, "raw")
    assert "01ff" in [r.id for r in search(by_raw).collect()]
    for bad in (dict(payload="value"), dict(payload="json", return_fields=["zz"]), dict(limit=-1), dict(sort=[ByField("raw")])):
        with pytest.raises(RequestError):
            search(c, **bad)


def test_request_errors(lines, spark):
    bad = [
        q.Range("n"), q.Regex("body", "^a"), q.Regex("body", "a$"), q.Phrase("body", ["one"]), q.StartsWith("n", "1"),
        q.Phrase("id", ["a", "b"]), q.DrillDown("id"), q.Match("x", operator="xor"), "text",
    ]
    for query in bad:
        with pytest.raises(RequestError):
            matches(lines, query)
    assert found(lines, q.Regex("body", r"[$^]|\$|fox")) == "abc"
    with pytest.raises(q.FieldError):
        matches(lines, q.Term("zz", 1))
    flags = Corpus(spark.createDataFrame([(True, '{"a":1}')], "b boolean, j string"), fields={"j": of_kind("json")})
    for query in (q.Range("b", gt=True), q.Term("j", "x"), q.In("j", ["x"])):
        with pytest.raises(RequestError):
            matches(flags, query)


def test_ranges_on_every_kind(spark):
    df = spark.createDataFrame(
        [("a", Decimal(1), 1.5, bytearray(b"a"), dt.datetime(2020, 1, 1)), ("b", Decimal(2**64 - 1), float("nan"), bytearray(b"b"), dt.datetime(1960, 1, 1))],
        "id string, u decimal(20,0), f double, y binary, at timestamp",
    )
    c = Corpus(df, "id")
    assert found(c, q.Range("u", gt=2**63)) == "b"
    assert found(c, q.Range("f", lte=2.0)) == "a"
    assert found(c, q.Range("y", gt=b"a")) == "b"
    assert found(c, q.Range("at", lt=dt.datetime(1970, 1, 1))) == "b"
    assert found(c, q.Range("at", gte=dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc))) == "a"


def test_multi_valued_aggregations(spark):
    df = spark.createDataFrame([("a", [1, 2, 2]), ("b", [4]), ("c", []), ("d", None)], "id string, v array<long>")
    c = Corpus(df, "id")
    m = aggregate(c, [
        Sum("s", "v"), Avg("m", "v"), Min("lo", "v"), Max("hi", "v"), Count("n", "v"), Stats("st", "v"),
        Cardinality("card", "v", exact=True), Percentiles("p", "v", [50], exact=True),
    ]).metrics.first()
    assert (m.s, m.m, m.lo, m.hi, m.n, m.card, m.p) == (9.0, 2.25, 1.0, 4.0, 4, 3, {"50.0": 2.0}) and m.st["count"] == 4
    h = aggregate(c, [Histogram("h", "v", 1.0)]).buckets["h"].orderBy("h").collect()
    assert [(r.h, r.doc_count) for r in h] == [(1.0, 1), (2.0, 2), (3.0, 0), (4.0, 1)]
    t = aggregate(c, [Terms("t", "v", sub=[Cardinality("ids", "id", exact=True)])]).buckets["t"].orderBy("t").collect()
    assert [(r.t, r.doc_count, r.ids) for r in t] == [(1, 1, 1), (2, 1, 1), (4, 1, 1)]
    assert [r.value for r in distinct_page(c, "v", 2, cursor=1).collect()] == [2, 4]


def test_three_levels_of_buckets(spark):
    rows = [(f"{i}", "x" if i % 3 else "y", float(i), dt.datetime(2024, 1, 1 + i % 4)) for i in range(24)]
    c = Corpus(spark.createDataFrame(rows, "id string, k string, v double, at timestamp"), "id")
    got = aggregate(c, [Terms("k", "k", 1, sub=[
        Ranges("r", "v", [Bucket(None, 10.0, "low"), Bucket(10.0, None, "high"), Bucket(99.0, None, "none")], sub=[
            DateHistogram("d", "at", "1d", sub=[Sum("s", "v")])]),
    ])])
    assert set(got.buckets) == {"k", "k.r", "k.r.d"}
    assert [(r.k, r.doc_count) for r in got.buckets["k"].collect()] == [("x", 16)]
    ranges = {r.r: r.doc_count for r in got.buckets["k.r"].collect()}
    want_low = sum(1 for _, k, v, _ in rows if k == "x" and v < 10)
    assert ranges == {"low": want_low, "high": 16 - want_low, "none": 0}
    deep = got.buckets["k.r.d"].collect()
    assert sum(r.doc_count for r in deep) == 16 and round(sum(r.s for r in deep)) == round(sum(v for _, k, v, _ in rows if k == "x"))


def test_aggregation_errors(lines):
    for bad in ([Sum("s", "body")], [Histogram("h", "n", 0)], [DateHistogram("d", "n", "1d")], [Ranges("r", "n")],
                [Sum("s", "n"), Avg("s", "n")], [Terms("t", "n", sub=[Sum("s", "tags")])], ["x"],
                [Terms("t", "n", sub=[Sum("t", "n")])], [Terms("t", "n", sub=[Sum("doc_count", "n")])]):
        with pytest.raises(RequestError):
            aggregate(lines, bad)


def test_approximate_answers_stay_in_bounds(spark):
    df = spark.range(20_000).select(F.col("id"), (F.col("id") % 5000).alias("v"))
    m = aggregate(Corpus(df, "id"), [Cardinality("c", "v"), Percentiles("p", "v")]).metrics.first()
    assert abs(m.c - 5000) <= 250
    assert set(m.p) == {"1.0", "5.0", "25.0", "50.0", "75.0", "95.0", "99.0"} and abs(m.p["50.0"] - 2500) <= 10


def test_duplicate_ids_are_legal(spark):
    df = spark.createDataFrame([("a", "x x"), ("a", "x"), ("b", "y")], "id string, t string")
    c = Corpus(df, "id", {"t": text()})
    rows = search(c, M("x"), snippets=[Snippet("t")]).collect()
    assert [(r.id, r.t) for r in rows] == [("a", "x x"), ("a", "x")] or [(r.id, r.t) for r in rows] == [("a", "x"), ("a", "x x")]


def test_batch_operators_on_an_index(lines, indexed, spark, monkeypatch):
    queries = spark.createDataFrame([(1, "quick fox"), (2, "lazy lazy")], "query_id long, text string")
    like = q.MoreLikeThis(None, min_doc_frequency=1, min_term_frequency=1)
    shown = lambda df: sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in df.collect())
    many, similar = shown(search_many(lines, queries)), shown(more_like_this(lines, like=like))
    assert many == shown(search_many(indexed, queries)) and similar == shown(more_like_this(indexed, like=like))
    # the same answers when nothing is small enough to broadcast
    monkeypatch.setattr("textquarry.operators.similar.BROADCAST_TERMS", 0)
    assert many == shown(search_many(lines, queries)) and similar == shown(more_like_this(indexed, like=like))


def test_empty_and_stored_pages_on_an_index(lines, indexed, tmp_path):
    assert search(indexed, M("absent")).collect() == []
    stored = lines.save(str(tmp_path / "c"), cluster_by_id=True).with_index(indexed.index)
    assert stored.unique_ids and stored.spec("body").kind == "text"
    page = search(stored, M("fox"), limit=1, offset=1, snippets=[Snippet("body")]).collect()
    assert page == search(lines, M("fox"), limit=1, offset=1, snippets=[Snippet("body")]).collect() and len(page) == 1


def test_wide_patterns_on_an_index(lines, indexed, monkeypatch):
    monkeypatch.setattr("textquarry.sources.postings.INLINE_TERMS", 1)
    assert found(indexed, q.Contains("body", "o")) == found(lines, q.Contains("body", "o"))


words = st.lists(st.sampled_from(["ab", "ba", "abc", "x", "yy"]), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(words, min_size=1, max_size=6), st.floats(0.5, 4.0))
def test_properties(spark, texts, factor):
    df = spark.createDataFrame([(i, " ".join(w), len(w)) for i, w in enumerate(texts)], "id long, t string, n long")
    c = Corpus(df, "id", {"t": text()})
    plain = {r.id: r.score for r in matches(c, M("ab x"), scored=True, columns=["id"]).collect()}
    assert set(plain) == {i for i, w in enumerate(texts) if {"ab", "x"} & set(w)}
    boosted = {r.id: r.score for r in matches(c, q.Boost(M("ab x"), factor), scored=True, columns=["id"]).collect()}
    assert all(math.isclose(boosted[i], factor * s, rel_tol=1e-12) for i, s in plain.items())
    buckets = aggregate(c, [Histogram("h", "n", 2.0)]).buckets["h"].collect()
    assert sum(b.doc_count for b in buckets) == len(texts)
    tokens = sorted({t for w in texts for t in w})
    assert [r.value for r in distinct_values(c, "t").orderBy("value").collect()] == tokens
    slop = q.Phrase("t", ["ab", "x"], slop=1)
    near = {i for i, w in enumerate(texts) if any(a == "ab" and "x" in w[k + 1:k + 3] for k, a in enumerate(w))}
    assert {r.id for r in matches(c, slop).collect()} == near
