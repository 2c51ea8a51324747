"""Deep pages against the ordinary ranks."""

import pytest
import textquarry as q
from textquarry.errors import RequestError
from textquarry.operators.deep import GlobalOrder
from textquarry.operators.search import ByField, Relevance, search


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(k, f"{'alpha ' * (k % 7)}beta{' gamma' * (k % 3)}", (k * 37) % 101 if k % 11 else None) for k in range(4000)]
    return q.Corpus(spark.createDataFrame(rows, "id long, body string, price long").repartition(6), "id", {"body": q.text()}, unique_ids=True)


SORTS = [(ByField("price", descending=True),), (ByField("price"), Relevance()), (Relevance(),)]


@pytest.mark.parametrize("sort", SORTS)
def test_pages_are_those_of_a_search(corpus, sort):
    order = GlobalOrder.of(corpus, q.Match("alpha gamma"), sort)
    total = search(corpus, q.Match("alpha gamma"), limit=10_000, sort=sort, payload="materialized", return_fields=["price"]).select("rank", "id", "price").collect()
    assert order.total == len(total)
    for limit, offset in ((10, 0), (700, 1500), (50, len(total) - 20), (10, 10_000), (0, 5)):
        got = order.page(limit, offset, ["price"]).select("rank", "id", "price").orderBy("rank").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in total[offset:offset + limit]]


def test_scores_and_other_columns(corpus):
    got = GlobalOrder.of(corpus, q.Match("alpha"), min_score=0.1).page(5, 100, ["body", "price"]).orderBy("rank").collect()
    want = search(corpus, q.Match("alpha"), limit=5, offset=100, min_score=0.1).collect()
    assert [(r["rank"], r.id, round(r.score, 9), r.body, r.price) for r in got] == [(r["rank"], str(r.id), round(r.score, 9), r.body, r.price) for r in want]


def test_no_task_holds_the_page_or_what_is_before_it(spark, corpus):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = GlobalOrder.of(corpus, None, (ByField("price"),))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [end - start for _, start, end in order.files]
    assert sum(files) == 4000 and max(files) < 2000
    page = order.page(3000, 500)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan and page.count() == 3000


def test_nothing_and_wrong_requests(corpus):
    empty = GlobalOrder.of(corpus, q.Match("absent"))
    assert empty.total == 0 and empty.page(10).collect() == []
    with pytest.raises(RequestError):
        empty.page(-1)
