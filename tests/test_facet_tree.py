"""Facets as nested intervals against sets of rows."""

import random

import pytest
import textquarry as q
from textquarry.errors import RequestError
from textquarry.operators.facet_tree import FacetTree


def _levels(path):
    parts = [p for p in path.split("/") if p]
    return {"/" + "/".join(parts[:n]) for n in range(len(parts) + 1)}


@pytest.fixture(scope="module")
def filed(spark, tmp_path_factory):
    pick = random.Random(6)
    names = ["a", "a b", "a!", "b", "ü", "c"]
    rows = []
    for k in range(300):
        paths = ["/" + "/".join(pick.choice(names) for _ in range(pick.randrange(1, 5))) for _ in range(pick.randrange(0, 5))]
        rows.append((k, paths + paths[:1], pick.choice(["red", "blue"])))
    rows += [(300, None, "red"), (301, [None, "/", "/a"], "red"), (302, ["/a//b", "/a/b", "/a/b/c"], "blue"), (303, ["/"], "red"), (None, ["/a"], "red")]
    df = spark.createDataFrame(rows, "id long, paths array<string>, colour string").repartition(5)
    corpus = q.Corpus(df, "id", {"paths": q.of_kind("facet")}, unique_ids=True)
    return rows, corpus, FacetTree.build(corpus, "paths", str(tmp_path_factory.mktemp("tree") / "t"))


def _brute(rows):
    held = {}
    for key, paths, _ in rows:
        for label in set().union(*[_levels(p) for p in paths or [] if p is not None]) if key is not None else ():
            held.setdefault(label, set()).add(key)
    return held


@pytest.mark.parametrize("colour", [None, "red", "green"])
def test_totals_of_all_levels(filed, colour):
    rows, _, tree = filed
    held = _brute([r for r in rows if colour in (None, r[2])])
    depth = lambda label: len([p for p in label.split("/") if p])
    children = {}
    for label in held:
        if label != "/":
            children[label.rsplit("/", 1)[0] or "/"] = children.get(label.rsplit("/", 1)[0] or "/", 0) + 1
    got = tree.totals(None if colour is None else q.Term("colour", colour)).collect()
    assert sorted(tuple(r) for r in got) == sorted((label, depth(label), len(ids), children.get(label, 0)) for label, ids in held.items())


def test_drill_down(filed):
    rows, _, tree = filed
    held = _brute(rows)
    for path in ((), ("a",), ("a", "b"), ("a b",), ("ü", "c"), ("none",)):
        assert sorted(r.id for r in tree.under(path).collect()) == sorted(held.get("/" + "/".join(path), ()))
    exact = {k for k, paths, _ in rows if k is not None and any(p is not None and [x for x in p.split("/") if x] == ["a"] for p in paths or [])}
    assert sorted(r.id for r in tree.under(["a"], only_this_level=True).collect()) == sorted(exact)


def test_numbers_are_nested(filed):
    nodes = filed[2].nodes.orderBy("pre").collect()
    assert [n.pre for n in nodes] == list(range(len(nodes))) and nodes[0].label == "/" and nodes[0].last == len(nodes) - 1
    for a in nodes:
        assert {b.label for b in nodes if a.pre <= b.pre <= a.last} == {b.label for b in nodes if b.segments[:a.depth] == a.segments}


def test_no_rows_and_other_fields(spark, filed, tmp_path):
    _, corpus, _ = filed
    tree = FacetTree.build(corpus.with_df(corpus.df.limit(0)), "paths", str(tmp_path / "none"))
    assert tree.totals().count() == 0 and tree.under().count() == 0
    with pytest.raises(RequestError):
        FacetTree.build(corpus, "colour", str(tmp_path / "no"))
