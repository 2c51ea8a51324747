"""Bounded top-k, grams and deletions against the plain ways."""

import random
import re

import pytest
from pyspark.sql import functions as F

import textquarry as q
from textquarry.errors import RequestError
from textquarry.operators import topk
from textquarry.operators.search import matches, search
from textquarry.sources import patterns
from textquarry.sources.impacts import BlockIndex
from textquarry.sources.patterns import END, START, PatternIndex, fuzzy_table, required_stretches
from textquarry.sources.postings import TermIndex


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts of very different lengths over a skewed vocabulary; equal texts give equal scores."""
    pick = random.Random(7)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(words[min(299, int(pick.paretovariate(0.6)) - 1)] for _ in range(min(3000, int(8 * pick.paretovariate(1.1)))))) for k in range(1500)]
    rows += [(2000 + k, "w0 w1 zeta") for k in range(40)] + [(3000, None), (3001, "")]
    return q.Corpus(spark.createDataFrame(rows, "id long, body string"), "id", {"body": q.text()}, unique_ids=True)


@pytest.fixture(scope="module")
def index(corpus, tmp_path_factory):
    return TermIndex.build(corpus, str(tmp_path_factory.mktemp("index") / "i"))


@pytest.fixture(scope="module")
def blocks(index, tmp_path_factory):
    return BlockIndex.build(index, str(tmp_path_factory.mktemp("blocks") / "b"), block_rows=4)


def page(frame):
    return [(r["rank"], r["id"], round(r["score"], 9)) for r in frame.orderBy("rank").collect()]


@pytest.mark.parametrize("text,limit,offset", [("w0", 10, 0), ("w0 w1 w7", 10, 0), ("w3 w3 w50", 25, 30), ("zeta w2", 15, 10), ("w1 nothing", 5, 0), ("w290", 100, 0), ("w0", 5000, 0)])
def test_top_hits_are_those_of_a_search(corpus, index, blocks, text, limit, offset):
    got = topk.top_hits(corpus.with_index(index), blocks, text, limit=limit, offset=offset)
    want = search(corpus.with_index(index), q.Match(text), limit=limit, offset=offset, payload="materialized", return_fields=["id"])
    want = want.select("rank", F.col("id").cast("long").alias("id"), "score")
    assert page(got.hits) == page(want)


def test_top_hits_read_fewer_postings_than_match(corpus, index, blocks):
    for text, part in (("w0 w60", 4), ("w0 w9", 2), ("w0", 2)):
        got = topk.top_hits(corpus.with_index(index), blocks, text, limit=5)
        print(text, got.postings.count(), got.matching.count())
        assert got.postings.count() < got.matching.count() / part


def test_top_hits_by_other_plans(corpus, index, blocks, monkeypatch):
    want = page(topk.top_hits(corpus.with_index(index), blocks, "w0 w4", limit=30).hits)
    for name, value in (("INLINE_STRETCHES", 1), ("INLINE_BLOCKS", 1), ("DEEPEST", 3)):
        with monkeypatch.context() as m:
            m.setattr(topk, name, value)
            assert page(topk.top_hits(corpus.with_index(index), blocks, "w0 w4", limit=30).hits) == want


def test_top_hits_of_nothing(corpus, index, blocks):
    with_index = corpus.with_index(index)
    assert topk.top_hits(with_index, blocks, "absent").hits.count() == 0
    assert topk.top_hits(with_index, blocks, "").hits.count() == 0
    assert topk.top_hits(with_index, blocks, "w0", limit=0).hits.columns == ["rank", "id", "score"]
    with pytest.raises(RequestError):
        topk.top_hits(corpus, blocks, "w0")
    rows = topk.with_rows(corpus, topk.top_hits(with_index, blocks, "zeta", limit=3).hits, 3).collect()
    assert [(r["rank"], r["id"], r["body"]) for r in rows] == [(k + 1, 2000 + k, "w0 w1 zeta") for k in range(3)]


WORDS = ["", "a", "ab", "abc", "station", "stations", "estion", "nation", "notion", "ration", "mention", "x.y", "über", "übel", "aa", "aaa", "banana", "1234", "a b"]


@pytest.fixture(scope="module")
def dictionary(spark, tmp_path_factory):
    terms = spark.createDataFrame([("body", w, k + 1) for k, w in enumerate(WORDS)], "field string, term string, df long")
    return terms, PatternIndex.build(terms, str(tmp_path_factory.mktemp("patterns") / "p"))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_fuzzy_table(spark, dictionary, distance):
    asked = ["statio", "xtation", "nation", "", "b", "übe", "bananas", "abcd", "nation", None, "zzzzzz"]
    table = spark.createDataFrame([(w, 1) for w in asked], "word string, df int")
    got = fuzzy_table(dictionary[1], table, distance, field="body").collect()
    want = [(w, t, edits(w, t), k + 1) for w in set(asked) - {None} for k, t in enumerate(WORDS) if edits(w, t) <= distance]
    assert sorted(map(tuple, got)) == sorted(want)
    with pytest.raises(RequestError):
        fuzzy_table(dictionary[1], table, 3, field="body")


PATTERNS = ["station", "sta.ion", "st[a-e]tions?", "(na|no)tion", "na?tion", "n.*tion", "[^x]+tion", "x\\.y", "a+b*c", "ban(an)+a", "\\d+", "a{2,3}", "(?i)STATION", "ti\\w+s", "[]a]bc", "über", "me(n)tion", "(a)(b)c", "nati(on)?", "[a\\]]bc", "abc.", "sta+tion+"]


def test_stretches_of_patterns_stand_in_every_fitting_word():
    pick = random.Random(3)
    words = WORDS + ["".join(pick.choice("abnotis") for _ in range(pick.randrange(9))) for _ in range(3000)]
    for pattern in PATTERNS:
        held = required_stretches(pattern)
        for w in words:
            if re.fullmatch(pattern, w):
                assert all(s in START + w + END for s in held), (pattern, w, held)
    assert required_stretches("station") == [START + "station" + END] and required_stretches("a|b") == []
    assert required_stretches("n.*tion") == [START + "n", "tion" + END] and required_stretches("na?tion") == [START + "n", "tion" + END]


@pytest.mark.parametrize("query", [q.Contains("body", "7"), q.Contains("body", "w28"), q.EndsWith("body", "99"), q.StartsWith("body", "w29"), q.Regex("body", "w2[0-4]5"),
                                   q.Regex("body", "z.ta"), q.Regex("body", ".*"), q.Fuzzy("body", "zetta", 1), q.Fuzzy("body", "w2", 2), q.Fuzzy("body", "zteas", 3)])
def test_patterns_by_their_index(corpus, index, tmp_path, query):
    looked_up = index.with_patterns(PatternIndex.build(index.terms, str(tmp_path / "p")))
    ids = lambda c: sorted(r.id for r in matches(c, query, columns=["id"]).collect())
    assert ids(corpus.with_index(looked_up)) == ids(corpus)


def test_the_dictionary_is_not_read_for_a_pattern_with_grams(index, dictionary):
    terms, built = dictionary
    held = TermIndex(index.postings, terms, index.lengths, built)
    needed = patterns.needed_by_literals(required_stretches("n[ao]tion"))
    plan = held.fitting("body", lambda t: t.rlike(r"\An[ao]tion\z"), needed)
    assert sorted(r.term for r in plan.collect()) == ["nation", "notion"]
    assert patterns.needed_by_literals(required_stretches(".*")) is None
    assert sorted(r.term for r in built.candidates("body", needed).collect()) == sorted(w for w in WORDS if w.endswith("tion"))
    assert all("grams" in f for f in plan.inputFiles())
