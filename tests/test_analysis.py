from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from textquarry import Corpus, FieldError, LiteralError, Phrase, Term, of_kind, text, tokenize
from textquarry.functions.analysis import ANALYZERS, analyze_literals
from textquarry.functions.stemmer import stem_word
from textquarry.functions.values import facet_ancestors, facet_child, html_escape, ip_canonical, is_json_object
from textquarry.operators.search import count
from textquarry.sources.fields import canonical_ip, from_millis

LONG = "x" * 39 + " " + "y" * 40 + " Ende"

CASES = [
    ("default", "Foo-Bar, été 42!", ["foo", "bar", "été", "42"]),
    ("default", LONG, ["x" * 39, "ende"]),
    ("default", "é" * 20, []),  # 20 characters, 40 bytes
    ("default", "", []),
    ("simple", "Foo-Bar été", ["Foo", "Bar", "été"]),
    ("whitespace", "Foo-Bar\tBAZ\n", ["foo-bar", "baz"]),
    ("whitespace_raw", "Foo-Bar\tBAZ", ["Foo-Bar", "BAZ"]),
    ("raw", "Foo Bar", ["Foo Bar"]),
    ("lowercase", "Foo Bar", ["foo bar"]),
    ("ngram_3_10", "FooBar", ["foo", "foob", "fooba", "foobar"]),
    ("ngram_3_10", "ab", []),
    ("ngram_3_10", "abcdefghijkl", ["abcdefghijkl"[:n] for n in range(3, 11)]),
    ("english_stem", "Running happily, relational", ["run", "happili", "relat"]),
    ("en_stem", "connections", ["connect"]),
]


@pytest.mark.parametrize("analyzer,value,tokens", CASES)
def test_tokenize(spark, analyzer, value, tokens):
    df = spark.createDataFrame([(value,), (None,)], "v string")
    got = [r[0] for r in df.select(tokenize(F.col("v"), analyzer)).collect()]
    assert got == [tokens, None]
    assert analyze_literals(spark, [(value, analyzer)]) == [tokens]


def test_every_analyzer_has_a_case():
    assert {a for a, _, _ in CASES} == set(ANALYZERS)


# Pairs from the published description of the algorithm.
STEMS = {
    "consign": "consign", "consigned": "consign", "consigning": "consign", "consistency": "consist",
    "consolation": "consol", "consolingly": "consol", "knightly": "knight", "knots": "knot", "kneeling": "kneel",
    "generously": "generous", "communication": "communic", "arsenal": "arsenal", "skies": "sky", "dying": "die", "news": "news",
    "inning": "inning", "proceed": "proceed", "caresses": "caress", "ties": "tie", "cries": "cri", "gas": "gas",
    "this": "this", "gaps": "gap", "kiwis": "kiwi", "hopping": "hop", "hoping": "hope", "luxuriated": "luxuri",
    "agreed": "agre", "feed": "feed", "cry": "cri", "by": "by", "say": "say", "sensational": "sensat",
    "rationalize": "ration", "hopefulness": "hope", "electrical": "electr", "adjustable": "adjust", "adoption": "adopt",
    "controlled": "control", "rate": "rate", "probate": "probat", "cease": "ceas", "youth": "youth", "boyish": "boyish",
}


@pytest.mark.parametrize("word", STEMS)
def test_stems(word):
    assert stem_word(word) == STEMS[word]


def test_dropped_token_keeps_its_position(spark):
    df = spark.createDataFrame([("a", "one " + "z" * 40 + " two"), ("b", "one two")], "id string, t string")
    c = Corpus(df, "id", {"t": text()})
    assert count(c, Phrase("t", ["one", "two"])).first().total == 1
    assert count(c, Phrase("t", ["one", "two"], slop=1)).first().total == 2


def test_helpers(spark):
    df = spark.createDataFrame([("/a/b/c", '<a href="x">&\'</a>', '{"k": 1}'), ("/a", "", "[1]")], "p string, h string, j string")
    row = df.select(
        facet_ancestors(F.col("p")).alias("up"), facet_child(F.col("p"), "/a").alias("child"),
        facet_child(F.col("p"), "/").alias("top"), html_escape(F.col("h")).alias("h"), is_json_object(F.col("j")).alias("j"),
    ).collect()
    assert row[0].up == ["/a", "/a/b", "/a/b/c"] and row[0].child == "/a/b" and row[0].top == "/a"
    assert row[1].child is None and [r.j for r in row] == [True, False]
    assert row[0].h == "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;&lt;/a&gt;"
    assert from_millis(-1).microsecond == 999000


ADDRESSES = [
    "10.1.2.3", "::ffff:10.1.2.3", "::FFFF:0A01:0203", "2001:0DB8:0000:0000:0000:0000:0000:0001", "2001:db8::1", "::", "::1",
    "1:0:0:2:0:0:0:3", "1:0:2:0:3:0:4:0", "fe80::", "1:2:3:4:5:6:7:8", "::1.2.3.4", "0:0:0:0:0:0:0:0", "1::2:0:0:3",
]
BROKEN = ["", "1.2.3", "256.1.1.1", "1:2", ":::", "1::2::3", "g::", "1:2:3:4:5:6:7:8:9", "12345::", "1:2:3:4:5:6:7:", "01.2.3.4"]


def test_addresses_have_one_spelling(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES + BROKEN], "a string").repartition(4)
    got = {r.a: r.c for r in df.select("a", ip_canonical(F.col("a")).alias("c")).collect()}
    for a in ADDRESSES:
        assert got[a] == canonical_ip(a), a
    assert [a for a in BROKEN if got[a] is not None] == []


def test_literals_are_not_coerced(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "s", True, bytearray(b"x"), "1.1.1.1", Decimal(5))],
        "i long, f double, s string, b boolean, y binary, ip string, u decimal(20,0)",
    )
    c = Corpus(df, "i", {"ip": of_kind("ip")})
    for name, bad in [("i", 1.0), ("i", True), ("i", 2**63), ("f", 1), ("s", 1), ("b", 1), ("y", "x"), ("ip", "no"), ("u", -1), ("u", 2**64)]:
        with pytest.raises(LiteralError):
            count(c, Term(name, bad))
    for name, good in [("i", 1), ("f", 1.0), ("s", "s"), ("b", True), ("y", b"x"), ("ip", "::ffff:1.1.1.1"), ("u", 5)]:
        assert count(c, Term(name, good)).first().total == 1, name


def test_bad_declarations(spark):
    df = spark.createDataFrame([(1, "x")], "i long, s string")
    for fields in ({"nope": text()}, {"i": text()}, {"s": text("unknown")}):
        with pytest.raises(FieldError):
            Corpus(df, "i", fields)
    with pytest.raises(FieldError):
        of_kind("unspecified")
