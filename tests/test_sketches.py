"""Merged sketches against exact values."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

import textquarry as q
from textquarry.errors import RequestError
from textquarry.operators.aggregate import Cardinality, Sum, aggregate
from textquarry.operators.sketches import SketchTable


def rows(n, seed):
    pick = random.Random(seed)
    return [(k, k % 30, pick.choice("abc"), pick.randrange(5000) if k % 7 else None, pick.choice([pick.lognormvariate(3, 1), float("nan"), None])) for k in range(n)]


def corpus(spark, held):
    df = spark.createDataFrame(held, "id long, day int, kind string, user long, price double").repartition(4)
    return q.Corpus(df, "id", {"kind": q.of_kind("string")})


def check(got, held):
    users, prices = {r[3] for r in held} - {None}, sorted(r[4] for r in held if r[4] is not None and r[4] == r[4])
    assert got.doc_count == len(held)
    assert abs(got.distinct_user - len(users)) <= 0.05 * len(users)
    for percent, value in got.quantiles_price.items():
        assert abs(bisect.bisect_left(prices, value) / len(prices) - float(percent) / 100) < 0.02


def test_merged_sketches_are_close(spark, tmp_path):
    held, later = rows(20_000, 1), rows(5_000, 2)
    by = {"day": F.col("day"), "kind": F.col("kind")}
    path = str(tmp_path / "s")
    SketchTable.write(corpus(spark, held), path, by, ["user"], ["price"])
    table = SketchTable.write(corpus(spark, later), path, by, ["user"], ["price"], mode="append")
    held += later
    [whole] = table.estimate(percents=(1, 25, 50, 95, 99)).collect()
    check(whole, held)
    [some] = table.estimate((F.col("day") < 10) & (F.col("kind") != "a"), percents=(50, 90)).collect()
    check(some, [r for r in held if r[1] < 10 and r[2] != "a"])
    for r in table.estimate(by=["kind"]).collect():
        check(r, [x for x in held if x[2] == r.kind])
    assert table.rows.count() == 180


def test_nothing_to_merge(spark, tmp_path):
    held = [(1, 1, "a", None, None), (2, 1, "a", None, float("nan")), (3, 2, None, 4, 1.5)]
    table = SketchTable.write(corpus(spark, held), str(tmp_path / "s"), {"kind": F.col("kind")}, ["user", "kind"], ["price"])
    got = {r.kind: (r.doc_count, r.distinct_user, r.distinct_kind, r.quantiles_price) for r in table.estimate(by=["kind"]).collect()}
    assert got == {"a": (2, 0, 1, None), None: (1, 1, 0, {"50.0": 1.5})}
    [none] = table.estimate(F.lit(False)).collect()
    assert (none.doc_count, none.distinct_user, none.quantiles_price) == (0, 0, None)
    with pytest.raises(RequestError):
        SketchTable.write(corpus(spark, held), str(tmp_path / "t"), {}, ["user"])
    with pytest.raises(RequestError):
        SketchTable.write(corpus(spark, held), str(tmp_path / "t"), {"kind": F.col("kind")}, quantiles=["kind"])


def test_exact_distinct_values_carry_no_sketch(spark):
    """Beside a sketch the exact number is a pass of its own: no group of one value holds a sketch of its rows."""
    rows = spark.createDataFrame([(k, k % 7 or None, float(k % 5)) for k in range(200)], "id long, v long, x double")
    got = aggregate(q.Corpus(rows, "id"), [Cardinality("about", "v"), Cardinality("exactly", "v", exact=True), Sum("total", "x")]).metrics
    assert tuple(got.first()) == (6, 6, 400.0) and got.columns == ["about", "exactly", "total"]
    for line in got._jdf.queryExecution().executedPlan().toString().splitlines():
        assert not ("keys=[" in line and "keys=[]" not in line and "approx_count_distinct" in line), line
