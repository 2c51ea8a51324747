"""Registered queries over typed columns: predicates, sorting, aggregations, maintenance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

import textquarry as q
from textquarry import Corpus, of_kind, text
from textquarry.catalog.shared import TOK, bm25_sql, docs, of_table, scored_sql, table
from textquarry.functions.values import facet_ancestors, json_value
from textquarry.operators.aggregate import (
    Avg, Bucket, Cardinality, Concat, Count, DateHistogram, Histogram, Max, Min, Percentiles, Ranges, Stats, Sum,
    Terms, aggregate, aggregate_together,
)
from textquarry.operators.deep import GlobalOrder
from textquarry.operators.distinct import distinct_page, distinct_values
from textquarry.operators.facet_tree import FacetTree
from textquarry.operators.facets import Facet, facet_counts
from textquarry.operators.search import ByField, IndexOrder, count, matches, search
from textquarry.operators.sketches import SketchTable
from textquarry.sources import maintain
from textquarry.sources.scratch import scratch_path
from textquarry.streaming import ingest, statistics

QUERIES, ORACLE = {}, {}


def register(name, run, sql=None):
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql


orders, lineitem, events = of_table("orders", "o_orderkey"), of_table("lineitem"), of_table("events", "event_id")
customer, part, pages = of_table("customer", "c_custkey"), of_table("part", "p_partkey"), of_table("pages", "page_id")
conversations = of_table("conversations")


def _rows(load, query, *columns):
    return lambda spark, sf: matches(load(spark, sf), query).select(*columns)


# -- predicates ----------------------------------------------------------------

register("all_rows", lambda spark, sf: count(orders(spark, sf), q.All()), "SELECT count(*) AS total FROM orders")
register("no_rows", lambda spark, sf: count(orders(spark, sf), q.Bool(should=[q.Nothing(), q.Term("o_orderstatus", "F")])),
         "SELECT count(*) AS total FROM orders WHERE o_orderstatus = 'F'")
register("term_raw", _rows(orders, q.Term("o_orderstatus", "F"), "o_orderkey"),
         "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
register(
    "term_raw_score",
    lambda spark, sf: matches(orders(spark, sf), q.Term("o_orderstatus", "F"), scored=True)
    .groupBy(F.round("score", 6).alias("score")).count().withColumnRenamed("count", "n"),
    "SELECT round(ln(1+(n-df+0.5)/(df+0.5))*2.2/(1+1.2), 6) AS score, df AS n FROM "
    "(SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS df FROM orders)",
)
register("exact", _rows(customer, q.Exact("c_mktsegment", "BUILDING"), "c_custkey"),
         "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
register("range_num", _rows(lineitem, q.Range("l_extendedprice", gt=20000.0, lte=60000.0), "l_orderkey", "l_linenumber", "l_extendedprice"),
         "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 20000 AND l_extendedprice <= 60000")
register("range_date", _rows(orders, q.Range("o_orderdate", gte=dt.datetime(1996, 1, 1), lt=dt.datetime(1997, 1, 1)), "o_orderkey"),
         "SELECT o_orderkey FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1997-01-01'")
register("range_string", _rows(customer, q.Range("c_name", gt="Customer#000000100"), "c_custkey"),
         "SELECT c_custkey FROM customer WHERE c_name > 'Customer#000000100'")
register("in_set", _rows(orders, q.In("o_orderpriority", ["1-URGENT", "5-LOW"]), "o_orderkey"),
         "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")

register(
    "in_table",
    lambda spark, sf: matches(
        customer(spark, sf),
        q.Bool(must=[q.All()], must_not=[q.In("c_custkey", table(spark, sf, "orders").where("o_totalprice > 400000").select("o_custkey"))]),
    ).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
)


def _with_gaps(spark, sf):
    df = table(spark, sf, "part").withColumn("size_or_null", F.nullif(F.col("p_size"), F.lit(11)))
    return Corpus(df, "p_partkey")


register("exists", _rows(_with_gaps, q.Exists("size_or_null"), "p_partkey"),
         "SELECT p_partkey FROM part WHERE nullif(p_size, 11) IS NOT NULL")
register("starts_with", _rows(part, q.StartsWith("p_name", "red"), "p_partkey"),
         "SELECT p_partkey FROM part WHERE starts_with(p_name, 'red')")
register("ends_with", _rows(part, q.EndsWith("p_name", "widget"), "p_partkey"),
         "SELECT p_partkey FROM part WHERE ends_with(p_name, 'widget')")
register("contains", _rows(pages, q.Contains("url", "example.net/en"), "page_id"),
         "SELECT page_id FROM pages WHERE contains(url, 'example.net/en')")
register("regex_full", _rows(pages, q.Regex("url", r"https?://m\.[a-z]+\.example\.(net|org)/.*"), "page_id"),
         r"SELECT page_id FROM pages WHERE regexp_full_match(url, 'https?://m\.[a-z]+\.example\.(net|org)/.*')")
register("fuzzy_string", _rows(part, q.Fuzzy("p_type", "SMLAL", 1, transpositions=True), "p_partkey"),
         "SELECT p_partkey FROM part WHERE damerau_levenshtein(p_type, 'SMLAL') <= 1")
register("drill_down", _rows(docs, q.DrillDown("path", ["en"]), "doc_id"), "SELECT doc_id FROM documents WHERE lang = 'en'")
register(
    "drill_down_level",
    _rows(docs, q.Bool(should=[q.DrillDown("path", [lang, *rest], only_this_level=True) for lang, rest in (("en", ()), ("en", ("src1",)), ("de", ("src2",)))]), "doc_id"),
    "SELECT doc_id FROM documents WHERE '/' || lang || '/' || source IN ('/en', '/en/src1', '/de/src2')",
)


def _addresses(spark, sf):
    """Event origins as IPv4-mapped addresses in two spellings."""
    user = F.col("user_id")
    v4 = F.concat_ws(".", F.lit("10"), F.lit("0"), F.floor(user / 256).cast("string"), (user % 256).cast("string"))
    mapped = F.concat(F.lit("::FFFF:0a00:"), F.lower(F.hex(user)))
    df = table(spark, sf, "events").withColumn("ip", F.when(F.col("event_id") % 2 == 0, v4).otherwise(mapped))
    return Corpus(df, "event_id", {"ip": of_kind("ip")})


register("ip_term", _rows(_addresses, q.Term("ip", "10.0.0.46"), "event_id"), "SELECT event_id FROM events WHERE user_id = 46")
register(
    "json_field",
    lambda spark, sf: table(spark, sf, "events").groupBy(json_value(F.col("props"), "$.k", "bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("n")),
    "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
)


def _tags(spark, sf):
    """Several values per row: the words of a part name."""
    df = table(spark, sf, "part").withColumn("tags", F.split("p_name", " "))
    return Corpus(df, "p_partkey")


register("multi_valued_term", _rows(_tags, q.Bool(must=[q.Term("tags", "red")], must_not=[q.Term("tags", "ring")]), "p_partkey"),
         "SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red') AND NOT list_contains(string_split(p_name, ' '), 'ring')")

# -- sorting, paging, payload ----------------------------------------------------

_SORT = [ByField("l_shipdate"), ByField("l_extendedprice", True), ByField("l_orderkey"), ByField("l_linenumber")]
register(
    "multi_sort_page",
    lambda spark, sf: search(lineitem(spark, sf), q.Range("l_quantity", gte=10.0), sort=_SORT, offset=100, limit=50,
                             with_score=False, payload="materialized",
                             return_fields=["l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber"]),
    "SELECT rank, l_shipdate, l_extendedprice, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (ORDER BY l_shipdate, "
    "l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem WHERE l_quantity >= 10) WHERE rank > 100 AND rank <= 150",
)
register(
    "page_deep",
    lambda spark, sf: GlobalOrder.of(lineitem(spark, sf), q.Range("l_quantity", gte=10.0), _SORT)
    .page(10_000, 30_000, ["l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber"]),
    "SELECT rank, l_shipdate, l_extendedprice, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (ORDER BY l_shipdate, "
    "l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem WHERE l_quantity >= 10) WHERE rank > 30000 AND rank <= 40000",
)
register(
    "sort_missing_values",
    lambda spark, sf: search(_with_gaps(spark, sf), sort=[ByField("size_or_null"), ByField("p_partkey", True)], limit=200,
                             with_score=False, payload="materialized", return_fields=["p_partkey", "size_or_null"])
    .select("rank", "p_partkey", "size_or_null"),
    "SELECT rank, p_partkey, size_or_null FROM (SELECT p_partkey, nullif(p_size, 11) AS size_or_null, row_number() OVER "
    "(ORDER BY nullif(p_size, 11) ASC NULLS FIRST, p_partkey DESC) AS rank FROM part) WHERE rank <= 200",
)
register(
    "index_order_desc",
    lambda spark, sf: search(orders(spark, sf), q.Term("o_orderstatus", "P"), sort=[IndexOrder(True)], limit=25,
                             with_score=False, payload="materialized", return_fields=["o_orderkey"]),
    "SELECT rank, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS rank "
    "FROM orders WHERE o_orderstatus = 'P') WHERE rank <= 25",
)
register(
    "payload_value",
    lambda spark, sf: search(customer(spark, sf), q.Term("c_mktsegment", "BUILDING"), sort=[ByField("c_acctbal", True)], limit=10,
                             with_score=False, payload="value", return_fields=["c_name"]),
    "SELECT rank, CAST(c_custkey AS VARCHAR) AS id, c_name AS value FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank "
    "FROM customer WHERE c_mktsegment = 'BUILDING') WHERE rank <= 10",
)
register(
    "payload_json",
    lambda spark, sf: search(orders(spark, sf), sort=[ByField("o_orderdate", True)], limit=20, with_score=False, payload="json",
                             return_fields=["o_orderkey", "o_orderstatus", "o_orderdate"]),
    "SELECT rank, CAST(o_orderkey AS VARCHAR) AS id, '{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || "
    "'\",\"o_orderdate\":' || epoch_ms(o_orderdate) || '}' AS json FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS rank "
    "FROM orders) WHERE rank <= 20",
)
register(
    "conversation_order",
    lambda spark, sf: search(conversations(spark, sf), q.Term("role", "user"), sort=[ByField("conv_id", True), ByField("turn")],
                             limit=100, with_score=False, payload="materialized", return_fields=["conv_id", "turn"]),
    "SELECT rank, conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id DESC, turn) AS rank FROM conversations "
    "WHERE role = 'user') WHERE rank <= 100",
)

# -- facets and distinct -------------------------------------------------------------

register(
    "facet_counts",
    lambda spark, sf: facet_counts(docs(spark, sf), [Facet("path"), Facet("path", ["en"], 5)]),
    "WITH a AS (SELECT 0 AS request, '/' || lang AS label, count(*) AS count FROM documents GROUP BY lang), "
    "b AS (SELECT 1 AS request, '/en/' || source AS label, count(*) AS count FROM documents WHERE lang = 'en' GROUP BY source) "
    "SELECT request, 'path' AS field, label, count, total_count, child_count FROM (SELECT *, sum(count) OVER (PARTITION BY request)::BIGINT AS total_count, "
    "count(*) OVER (PARTITION BY request) AS child_count, row_number() OVER (PARTITION BY request ORDER BY count DESC, label) AS pos "
    "FROM (FROM a UNION ALL FROM b)) WHERE pos <= CASE request WHEN 0 THEN 10 ELSE 5 END",
)
register(
    "facet_counts_filtered",
    lambda spark, sf: facet_counts(docs(spark, sf), [Facet("path")], q.Match("the")).select("label", "count"),
    f"WITH {TOK} SELECT '/' || lang AS label, count(*) AS count FROM documents WHERE doc_id IN (SELECT doc_id FROM tok WHERE term = 'the') GROUP BY lang",
)
_tree = lambda corpus, field: FacetTree.build(corpus, field, scratch_path(corpus.spark, "facets"))
register(
    "facet_tree",
    lambda spark, sf: _tree(docs(spark, sf), "path").totals(q.Match("the")),
    f"WITH {TOK}, hit AS (SELECT lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM tok WHERE term = 'the') AND lang IS NOT NULL AND source IS NOT NULL) "
    "SELECT '/' AS label, 0 AS depth, count(*) AS count, count(DISTINCT lang) AS child_count FROM hit HAVING count(*) > 0 "
    "UNION ALL SELECT '/' || lang, 1, count(*), count(DISTINCT source) FROM hit GROUP BY lang "
    "UNION ALL SELECT '/' || lang || '/' || source, 2, count(*), 0 FROM hit GROUP BY lang, source",
)
register("facet_tree_drill", lambda spark, sf: _tree(docs(spark, sf), "path").under(["en"]), "SELECT doc_id FROM documents WHERE lang = 'en' AND source IS NOT NULL")


def _filed(spark, sf):
    """Several paths per row: the words of a part name and its type."""
    named = F.transform(F.split("p_name", " "), lambda w: F.concat(F.lit("/name/"), w))
    df = table(spark, sf, "part").withColumn("paths", F.array_append(named, F.concat(F.lit("/type/"), F.col("p_type"))))
    return Corpus(df, "p_partkey", {"paths": of_kind("facet")}, unique_ids=True)


register(
    "facet_tree_multi_valued",
    lambda spark, sf: _tree(_filed(spark, sf), "paths").totals().select("label", "count"),
    "WITH f AS (SELECT p_partkey, unnest(list_append(list_transform(string_split(p_name, ' '), lambda x: '/name/' || x), '/type/' || p_type)) AS path FROM part), "
    "l AS (SELECT DISTINCT p_partkey, unnest(['/', '/' || split_part(path, '/', 2), path]) AS label FROM f) SELECT label, count(*) AS count FROM l GROUP BY label",
)
register(
    "distinct_page",
    lambda spark, sf: distinct_page(customer(spark, sf), "c_name", 40, cursor="Customer#000000020", query=q.Term("c_mktsegment", "MACHINERY")),
    "SELECT DISTINCT c_name AS value FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_name > 'Customer#000000020' ORDER BY 1 LIMIT 40",
)
register("distinct_values", lambda spark, sf: distinct_values(lineitem(spark, sf), "l_shipdate"),
         "SELECT DISTINCT l_shipdate AS value FROM lineitem")
register("distinct_multi_valued", lambda spark, sf: distinct_page(_tags(spark, sf), "tags", 5, cursor="blue"),
         "SELECT DISTINCT value FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) WHERE value > 'blue' ORDER BY value LIMIT 5")

# -- aggregations -----------------------------------------------------------------------

_ALL_METRICS = [
    Sum("sum_price", "l_extendedprice"), Avg("avg_price", "l_extendedprice"), Min("min_price", "l_extendedprice"),
    Max("max_price", "l_extendedprice"), Count("n", "l_extendedprice"), Stats("stats", "l_quantity"),
]


def _metrics(query):
    def run(spark, sf):
        m = aggregate(lineitem(spark, sf), _ALL_METRICS, query).metrics
        return m.select(
            *[F.round(c, 2).alias(c) for c in ("sum_price", "avg_price", "min_price", "max_price")], "n",
            F.col("stats.count").alias("stats_count"),
            *[F.round(f"stats.{c}", 4).alias(f"stats_{c}") for c in ("sum", "min", "max", "avg")],
        )

    return run


_METRICS_SQL = (
    "SELECT round(coalesce(sum(l_extendedprice), 0), 2) AS sum_price, round(coalesce(avg(l_extendedprice), 0), 2) AS avg_price, "
    "round(coalesce(min(l_extendedprice), 0), 2) AS min_price, round(coalesce(max(l_extendedprice), 0), 2) AS max_price, "
    "count(l_extendedprice) AS n, count(l_quantity) AS stats_count, round(coalesce(sum(l_quantity), 0), 4) AS stats_sum, "
    "round(coalesce(min(l_quantity), 0), 4) AS stats_min, round(coalesce(max(l_quantity), 0), 4) AS stats_max, "
    "round(coalesce(avg(l_quantity), 0), 4) AS stats_avg FROM lineitem WHERE "
)
register("metrics", _metrics(q.Term("l_returnflag", "R")), _METRICS_SQL + "l_returnflag = 'R'")
register("stats_empty", _metrics(q.Term("l_returnflag", "none")), _METRICS_SQL + "l_returnflag = 'none'")
register(
    "cardinality_exact",
    lambda spark, sf: aggregate(lineitem(spark, sf), [Cardinality("parts", "l_partkey", exact=True)]).metrics,
    "SELECT count(DISTINCT l_partkey) AS parts FROM lineitem",
)
register(
    "cardinality_approx_bound",
    lambda spark, sf: aggregate(
        lineitem(spark, sf), [Cardinality("about", "l_partkey"), Cardinality("exactly", "l_partkey", exact=True)]
    ).metrics.select((F.abs(F.col("about") - F.col("exactly")) <= 0.1 * F.col("exactly")).alias("close")),
    "SELECT count(DISTINCT l_partkey) > 0 AS close FROM lineitem",
)


def _sketched(spark, sf):
    """Per order status in some months: stored sketches merged, beside whether they keep their stated error (three times it)."""
    corpus = orders(spark, sf)
    by = {"month": F.date_trunc("month", "o_orderdate"), "status": F.col("o_orderstatus")}
    stored = SketchTable.write(corpus, scratch_path(spark, "sketches"), by, ["o_custkey"], ["o_totalprice"])
    some = (F.col("month") >= dt.datetime(1995, 1, 1)) & (F.col("month") < dt.datetime(1997, 1, 1))
    merged = stored.estimate(some, ["status"])
    exact = corpus.df.where((F.col("o_orderdate") >= dt.datetime(1995, 1, 1)) & (F.col("o_orderdate") < dt.datetime(1997, 1, 1))).join(
        merged.select(F.col("status").alias("o_orderstatus"), F.col("quantiles_o_totalprice")["50.0"].alias("median")), "o_orderstatus")
    exact = exact.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count_distinct("o_custkey").alias("customers"), F.avg((F.col("o_totalprice") < F.col("median")).cast("int")).alias("below"))
    return merged.join(exact, "status").select(
        "status", "doc_count", "customers", (F.abs(F.col("distinct_o_custkey") - F.col("customers")) <= 0.05 * F.col("customers") + 1).alias("distinct_close"),
        (F.abs(F.col("below") - 0.5) <= 0.03).alias("median_close"))


register(
    "sketched_by_month", _sketched,
    "SELECT o_orderstatus AS status, count(*) AS doc_count, count(DISTINCT o_custkey) AS customers, true AS distinct_close, true AS median_close "
    "FROM orders WHERE o_orderdate >= '1995-01-01' AND o_orderdate < '1997-01-01' GROUP BY 1",
)
_PERCENTS = [1.0, 50.0, 95.0]
register(
    "percentiles_exact",
    lambda spark, sf: aggregate(lineitem(spark, sf), [Percentiles("p", "l_extendedprice", _PERCENTS, exact=True)]).metrics.select(
        *[F.round(F.col("p")[str(p)], 4).alias(f"p{int(p)}") for p in _PERCENTS]),
    "SELECT " + ", ".join(f"round(quantile_cont(l_extendedprice, {p / 100}), 4) AS p{int(p)}" for p in _PERCENTS) + " FROM lineitem",
)
register(
    "percentiles_approx_bound",
    lambda spark, sf: aggregate(
        lineitem(spark, sf), [Percentiles("a", "l_extendedprice"), Percentiles("e", "l_extendedprice", exact=True)]
    ).metrics.select(F.forall(
        F.map_entries("a"), lambda e: F.abs(e["value"] - F.col("e")[e["key"]]) <= 0.02 * F.col("e")[e["key"]]
    ).alias("close")),
    "SELECT count(*) > 0 AS close FROM lineitem",
)
register(
    "histogram_gapfill",
    lambda spark, sf: aggregate(customer(spark, sf), [
        Histogram("balance", "c_acctbal", 25.0, sub=[Avg("mean", "c_acctbal"), Count("n", "c_custkey")])
    ], q.Term("c_nationkey", 7)).buckets["balance"].select("balance", "doc_count", F.round("mean", 4).alias("mean"), "n"),
    "WITH h AS (SELECT floor(c_acctbal / 25.0)::BIGINT AS b, count(*) AS c, avg(c_acctbal) AS m FROM customer WHERE c_nationkey = 7 GROUP BY 1), "
    "g AS (SELECT unnest(generate_series((SELECT min(b) FROM h), (SELECT max(b) FROM h))) AS b) "
    "SELECT b * 25.0::DOUBLE AS balance, coalesce(c, 0) AS doc_count, round(coalesce(m, 0), 4) AS mean, coalesce(c, 0) AS n FROM g LEFT JOIN h USING (b)",
)
register(
    "date_histogram",
    lambda spark, sf: aggregate(events(spark, sf), [
        DateHistogram("hour", "ts", "1h", sub=[Sum("total", "value")])
    ], q.Term("event_type", "purchase")).buckets["hour"].select("hour", "doc_count", F.round("total", 2).alias("total")),
    "WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS c, sum(value) AS t FROM events WHERE event_type = 'purchase' GROUP BY 1), "
    "g AS (SELECT unnest(generate_series((SELECT min(hour) FROM h), (SELECT max(hour) FROM h), INTERVAL 1 HOUR)) AS hour) "
    "SELECT hour, coalesce(c, 0) AS doc_count, round(coalesce(t, 0), 2) AS total FROM g LEFT JOIN h USING (hour)",
)
register(
    "date_histogram_offset",
    lambda spark, sf: aggregate(events(spark, sf), [
        DateHistogram("day", "ts", "1d", offset="6h", min_doc_count=1)]).buckets["day"],
    "SELECT date_trunc('day', ts - INTERVAL 6 HOUR) + INTERVAL 6 HOUR AS day, count(*) AS doc_count FROM events GROUP BY 1",
)
register(
    "terms",
    lambda spark, sf: aggregate(lineitem(spark, sf), [Terms("supplier", "l_suppkey", 7)]).buckets["supplier"],
    "SELECT l_suppkey AS supplier, count(*) AS doc_count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7",
)
register(
    "terms_multi_valued",
    lambda spark, sf: aggregate(_tags(spark, sf), [Terms("tag", "tags", 20)]).buckets["tag"],
    "SELECT tag, count(DISTINCT p_partkey) AS doc_count FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part) "
    "GROUP BY tag ORDER BY 2 DESC, 1 LIMIT 20",
)
register(
    "terms_of_text",
    lambda spark, sf: aggregate(docs(spark, sf), [Terms("word", "text", 25)], q.Term("lang", "fr")).buckets["word"],
    f"WITH {TOK} SELECT term AS word, count(DISTINCT doc_id) AS doc_count FROM tok JOIN documents USING (doc_id) WHERE lang = 'fr' "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
)


def _nested(spark, sf):
    request = [Terms("priority", "o_orderpriority", 3, sub=[
        Avg("mean", "o_totalprice"),
        DateHistogram("month", "o_orderdate", "30d", min_doc_count=1, sub=[
            Max("top", "o_totalprice"), Terms("status", "o_orderstatus", 2, sub=[Sum("total", "o_totalprice")])]),
    ])]
    return aggregate(orders(spark, sf), request).buckets


register(
    "terms_sub_agg",
    lambda spark, sf: _nested(spark, sf)["priority"].select("priority", "doc_count", F.round("mean", 2).alias("mean")),
    "SELECT o_orderpriority AS priority, count(*) AS doc_count, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3",
)
_TOP3 = "top3 AS (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)"
_MONTH = "make_timestamp(CAST(floor(epoch(o_orderdate) / 2592000) * 2592000 AS BIGINT) * 1000000)"
register(
    "nested_buckets_two",
    lambda spark, sf: _nested(spark, sf)["priority.month"],
    f"WITH {_TOP3} SELECT o_orderpriority AS priority, {_MONTH} AS month, count(*) AS doc_count, max(o_totalprice) AS top "
    "FROM orders JOIN top3 USING (o_orderpriority) GROUP BY 1, 2",
)
register(
    "nested_buckets_three",
    lambda spark, sf: _nested(spark, sf)["priority.month.status"].withColumn("total", F.round("total", 2)),
    f"WITH {_TOP3}, c AS (SELECT o_orderpriority AS priority, {_MONTH} AS month, o_orderstatus AS status, count(*) AS doc_count, "
    "round(sum(o_totalprice), 2) AS total FROM orders JOIN top3 USING (o_orderpriority) GROUP BY 1, 2, 3) "
    "SELECT priority, month, status, doc_count, total FROM (SELECT *, row_number() OVER (PARTITION BY priority, month "
    "ORDER BY doc_count DESC, status) AS pos FROM c) WHERE pos <= 2",
)


def _several(spark, sf):
    """Three aggregations and a level below one of them, from one pass, as one table of keys and counts."""
    levels = aggregate_together(orders(spark, sf), [
        Terms("priority", "o_orderpriority", 3, sub=[Terms("status", "o_orderstatus", 2, sub=[Sum("total", "o_totalprice")])]),
        Histogram("price", "o_totalprice", 50_000.0, min_doc_count=1, sub=[Sum("total", "o_totalprice")]),
        Ranges("size", "o_totalprice", [Bucket(None, 20_000.0, "small"), Bucket(20_000.0, None, "large")], sub=[Sum("total", "o_totalprice")]),
    ])
    out = None
    for path, level in levels.items():
        keys = [F.col(f"`{k}`").cast("string") for k in path.split(".")]
        total = F.round("total", 2) if "total" in level.columns else F.lit(None).cast("double")
        part = level.select(F.lit(path).alias("level"), F.concat_ws("/", *keys).alias("bucket"), "doc_count", total.alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


register(
    "several_buckets", _several,
    f"WITH {_TOP3}, st AS (SELECT o_orderpriority AS p, o_orderstatus AS s, count(*) AS c, round(sum(o_totalprice), 2) AS t FROM orders JOIN top3 USING (o_orderpriority) GROUP BY 1, 2) "
    "SELECT 'priority' AS level, o_orderpriority AS bucket, count(*) AS doc_count, NULL::DOUBLE AS total FROM orders JOIN top3 USING (o_orderpriority) GROUP BY 2 "
    "UNION ALL SELECT 'priority.status', p || '/' || s, c, t FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY c DESC, s) AS pos FROM st) WHERE pos <= 2 "
    "UNION ALL SELECT 'price', (floor(o_totalprice / 50000) * 50000.0::DOUBLE)::VARCHAR, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY 2 "
    "UNION ALL SELECT 'size', CASE WHEN o_totalprice < 20000 THEN 'small' ELSE 'large' END, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY 2",
)
register(
    "range_buckets",
    lambda spark, sf: aggregate(lineitem(spark, sf), [Ranges("price", "l_extendedprice", [
        Bucket(None, 10000.0), Bucket(10000.0, 50000.0, "middle"), Bucket(40000.0), Bucket(1e9, None, "none")
    ], sub=[Avg("qty", "l_quantity")])]).buckets["price"].select("price", "from", "to", "doc_count", F.round("qty", 4).alias("qty")),
    "SELECT price, \"from\", \"to\", count(l_quantity) AS doc_count, round(coalesce(avg(l_quantity), 0), 4) AS qty FROM "
    "(VALUES ('*-10000.0', NULL::DOUBLE, 10000.0::DOUBLE), ('middle', 10000, 50000), ('40000.0-*', 40000, NULL), ('none', 1e9, NULL)) b(price, \"from\", \"to\") "
    "LEFT JOIN lineitem ON l_extendedprice >= coalesce(\"from\", '-inf'::DOUBLE) AND l_extendedprice < coalesce(\"to\", 'inf'::DOUBLE) GROUP BY 1, 2, 3",
)
register(
    "nested_histogram_gaps",
    lambda spark, sf: aggregate(events(spark, sf), [Terms("kind", "event_type", sub=[Histogram("value", "value", 20.0)])]).buckets["kind.value"],
    "WITH h AS (SELECT event_type AS kind, floor(value / 20)::BIGINT AS b, count(*) AS c FROM events GROUP BY 1, 2), "
    "g AS (SELECT kind, unnest(generate_series(min(b), max(b))) AS b FROM h GROUP BY kind) "
    "SELECT kind, b * 20.0::DOUBLE AS value, coalesce(c, 0) AS doc_count FROM g LEFT JOIN h USING (kind, b)",
)
register(
    "concat_top",
    lambda spark, sf: aggregate(docs(spark, sf), [Concat("ids", "doc_id", max_docs=15, separator="|")], q.Match("estion ndat")).metrics,
    f"{scored_sql(['estion', 'ndat'])} SELECT string_agg(doc_id, '|' ORDER BY rank) AS ids FROM (SELECT doc_id, row_number() OVER "
    "(ORDER BY s0 + s1 DESC, doc_id) AS rank FROM sc WHERE f0 + f1 > 0) WHERE rank <= 15",
)
register(
    "several_aggs",
    lambda spark, sf: aggregate(docs(spark, sf), [
        Count("n", "doc_id"), Max("longest", "n_chars"), Cardinality("sources", "source", exact=True)], q.Match("the")).metrics,
    f"WITH {TOK} SELECT count(*) AS n, max(n_chars)::DOUBLE AS longest, count(DISTINCT source) AS sources FROM documents "
    "WHERE doc_id IN (SELECT doc_id FROM tok WHERE term = 'the')",
)

# -- maintenance ----------------------------------------------------------------------------


def _renamed(spark, sf):
    """Updates for one nation's customers, each sent twice; the later one counts."""
    base = table(spark, sf, "customer").where("c_nationkey = 7")
    first = base.withColumn("c_acctbal", F.lit(0.0)).withColumn("at", F.lit(1))
    second = base.withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("at", F.lit(2))
    new = second.withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    return first.unionByName(second).unionByName(new)


register(
    "upsert",
    lambda spark, sf: maintain.upsert(customer(spark, sf), _renamed(spark, sf), order_by="at").df.select(
        "c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal")),
    "SELECT c_custkey, c_name, round(CASE WHEN c_nationkey = 7 THEN c_acctbal + 1 ELSE c_acctbal END, 2) AS c_acctbal FROM customer "
    "UNION ALL SELECT c_custkey + 10000000, c_name, round(c_acctbal + 1, 2) FROM customer WHERE c_nationkey = 7",
)
register(
    "append",
    lambda spark, sf: maintain.append(customer(spark, sf), table(spark, sf, "customer").select("c_custkey", "c_name"))
    .df.select("c_custkey", "c_name", "c_mktsegment"),
    "SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL SELECT c_custkey, c_name, NULL FROM customer",
)
register(
    "delete_by_id",
    lambda spark, sf: maintain.delete(
        customer(spark, sf),
        table(spark, sf, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey")),
    ).df.select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)
register(
    "delete_by_query",
    lambda spark, sf: maintain.delete_where(customer(spark, sf), q.Range("c_acctbal", lt=500.0)).corpus.df.select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE NOT (c_acctbal < 500)",
)
register(
    "delete_by_text_query",
    lambda spark, sf: maintain.delete_where(docs(spark, sf), q.Match("the")).removed,
    f"WITH {TOK} SELECT count(DISTINCT doc_id) AS removed FROM tok WHERE term = 'the'",
)
register(
    "truncate",
    lambda spark, sf: maintain.append(maintain.truncate(customer(spark, sf)), table(spark, sf, "customer").where("c_acctbal < 0")).df.select("c_custkey", "c_name"),
    "SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0",
)


def _stored(spark, sf):
    """Customers stored by id bucket, then updated by a second and a late third batch."""
    path = scratch_path(spark, "stored")
    ingest.upsert_rows(table(spark, sf, "customer").withColumn("at", F.lit(0)), path, "c_custkey", "at", 8)
    ingest.upsert_rows(_renamed(spark, sf), path, "c_custkey", "at")
    ingest.upsert_rows(_renamed(spark, sf).where("at = 1"), path, "c_custkey", "at")
    return path


def _stored_rows(spark, path):
    return ingest.open_upserted(spark, path, "c_custkey").df.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"))


def _stored_delete(spark, sf):
    path = _stored(spark, sf)
    ids = table(spark, sf, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    ingest.delete_stored(spark, path, "c_custkey", ids)
    ingest.delete_where_stored(spark, path, "c_custkey", q.Range("c_acctbal", lt=0.0))
    return _stored_rows(spark, path)


_UPDATED = (
    "SELECT c_custkey, c_name, round(CASE WHEN c_nationkey = 7 THEN c_acctbal + 1 ELSE c_acctbal END, 2) AS c_acctbal FROM customer "
    "UNION ALL SELECT c_custkey + 10000000, c_name, round(c_acctbal + 1, 2) FROM customer WHERE c_nationkey = 7"
)
register("stored_upsert", lambda spark, sf: _stored_rows(spark, _stored(spark, sf)), _UPDATED)
register(
    "stored_delete", _stored_delete,
    f"SELECT * FROM ({_UPDATED}) WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)


def _stream_statistics(spark, sf):
    """Documents arriving as a stream; their statistics as of its last batch."""
    path = scratch_path(spark, "statistics")
    stream = spark.readStream.schema(table(spark, sf, "documents").schema).parquet(f"{sf}/documents.parque[t]")
    statistics.statistics_stream(stream, f"{path}/totals", f"{path}/checkpoint", id_col="doc_id", text_col="text").awaitTermination()
    return statistics.read_statistics(spark, f"{path}/totals").withColumn("term", F.coalesce("term", F.lit("")))


register(
    "stream_statistics", _stream_statistics,
    f"WITH {TOK} SELECT term, count(DISTINCT doc_id) AS n_rows, count(*) AS n_terms FROM tok GROUP BY term "
    "UNION ALL SELECT '', (SELECT count(*) FROM documents), (SELECT count(*) FROM tok)",
)
register(
    "save_open",
    lambda spark, sf: matches(customer(spark, sf).save(scratch_path(spark, "saved"), cluster_by_id=True), q.Range("c_acctbal", gte=5000.0)).select("c_custkey", "c_name"),
    "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 5000",
)


def _typed(spark, sf):
    """Orders with a flag, an unsigned number and bytes."""
    df = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 200000).alias("big"), F.col("o_orderkey").cast("decimal(20,0)").alias("u"), F.encode("o_orderpriority", "UTF-8").alias("raw"))
    return Corpus(df, "o_orderkey")


register("term_bool", _rows(_typed, q.Term("big", True), "o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_totalprice > 200000")
register("range_u64", _rows(_typed, q.Range("u", gte=100, lt=900), "o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 900")
register("term_bytes", _rows(_typed, q.Term("raw", b"1-URGENT"), "o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
register(
    "payload_doc",
    lambda spark, sf: search(customer(spark, sf), q.Range("c_acctbal", gte=9000.0), limit=25, sort=[ByField("c_acctbal", descending=True)], with_score=False, payload="doc").drop("id"),
    "SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey)::INT AS rank, * FROM customer WHERE c_acctbal >= 9000 ORDER BY rank LIMIT 25",
)
register(
    "facet_levels",
    lambda spark, sf: docs(spark, sf).df.select(F.explode(facet_ancestors(F.col("path"))).alias("level")).groupBy("level").agg(F.count("*").alias("n")),
    "SELECT level, count(*) AS n FROM (SELECT '/' || lang AS level FROM documents UNION ALL SELECT '/' || lang || '/' || source FROM documents) GROUP BY level",
)
