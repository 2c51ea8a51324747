import datetime as dt

import pytest
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.operators.search import count
from textquarry.plans.query import Range
from textquarry.streaming import ingest, statistics

SCHEMA = "id string, name string, at long"


def _land(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder))


def _run(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def _lose_commit(checkpoint, batch):
    """As if the stream had died before it noted that ``batch`` was done."""
    for name in (str(batch), f".{batch}.crc"):
        (checkpoint / "commits" / name).unlink()


def _rows(spark, out):
    return sorted(tuple(r) for r in ingest.open_upserted(spark, out, "id").df.select("id", "name", "at").collect())


def test_append_then_read(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    _land(spark, src, [("a", "x", 1), ("b", "y", 2)])
    _run(ingest.append_stream(spark.readStream.schema(SCHEMA).json(src), out, chk))
    _land(spark, src, [("a", "z", 3)])
    _run(ingest.append_stream(spark.readStream.schema(SCHEMA).json(src), out, chk))
    assert ingest.read_appended(spark, out).count() == 3


def test_two_streams_append_to_one_path(spark, tmp_path):
    out = str(tmp_path / "out")
    for name, rows in (("one", [("a", "x", 1), ("b", "y", 2)]), ("two", [("c", "z", 3)])):
        _land(spark, tmp_path / name, rows)
        _run(ingest.append_stream(spark.readStream.schema(SCHEMA).json(str(tmp_path / name)), out, str(tmp_path / f"chk-{name}")))
    assert {r.id for r in ingest.read_appended(spark, out).collect()} == {"a", "b", "c"}


def test_a_replayed_batch_is_there_once(spark, tmp_path):
    """The commit of the last batch is lost, so the stream runs it again."""
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    _land(spark, src, [("a", "x", 1), ("b", "y", 2)])
    for _ in range(2):
        _run(ingest.append_stream(spark.readStream.schema(SCHEMA).json(src), out, chk))
        _lose_commit(tmp_path / "chk", 0)
    assert sorted(r.id for r in ingest.read_appended(spark, out).collect()) == ["a", "b"]


def test_upserts_keep_the_last_row_per_id(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("src", "out", "chk"))
    options = dict(id_col="id", order_by="at", buckets=4)
    _land(spark, src, [(f"k{i}", "first", 1) for i in range(20)] + [("k1", "second", 2)])
    _run(ingest.upsert_stream(spark.readStream.schema(SCHEMA).json(src), out, chk, **options))
    _land(spark, src, [("k2", "third", 3), ("new", "third", 3)])
    _run(ingest.upsert_stream(spark.readStream.schema(SCHEMA).json(src), out, chk, **options))
    corpus = ingest.open_upserted(spark, out, "id")
    names = {r.id: r.name for r in corpus.df.collect()}
    assert count(corpus).first().total == 21 and len(names) == 21
    assert names["k1"] == "second" and names["k2"] == names["new"] == "third" and names["k3"] == "first"


def test_a_new_checkpoint_comes_after_what_is_stored(spark, tmp_path):
    out = str(tmp_path / "out")
    for n, rows in enumerate(([("a", "old", 1), ("b", "old", 1)], [("a", "new", 2)])):
        _land(spark, tmp_path / f"src{n}", rows)
        source = spark.readStream.schema(SCHEMA).json(str(tmp_path / f"src{n}"))
        _run(ingest.upsert_stream(source, out, str(tmp_path / f"chk{n}"), id_col="id", order_by="at", buckets=2))
    assert _rows(spark, out) == [("a", "new", 2), ("b", "old", 1)]


def test_replayed_and_late_batches(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    ingest.upsert_rows(batch(("a", "1", 1), ("b", "1", 1)), out, "id", "at", 2)
    for _ in range(2):
        ingest.upsert_rows(batch(("a", "5", 5)), out, "id", "at", 2)
    ingest.upsert_rows(batch(("a", "late", 3), ("b", "same", 1)), out, "id", "at")
    ingest.upsert_rows(spark.createDataFrame([], SCHEMA), out, "id", "at")
    assert _rows(spark, out) == [("a", "5", 5), ("b", "same", 1)]


def test_the_number_of_buckets_is_kept(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"k{i}", "x", i) for i in range(20)], SCHEMA)
    ingest.upsert_rows(rows, out, "id", "at", 4)
    with pytest.raises(RequestError):
        ingest.upsert_rows(rows, out, "id", "at", 8)
    ingest.upsert_rows(rows.withColumn("at", F.col("at") + 100), out, "id", "at")
    assert len(_rows(spark, out)) == 20 and min(r[2] for r in _rows(spark, out)) == 100


def test_stored_deletes(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(RequestError):
        ingest.truncate_stored(spark, out)
    ingest.upsert_rows(spark.createDataFrame([(f"k{i}", "x", i) for i in range(12)], SCHEMA), out, "id", "at", 3)
    ingest.delete_stored(spark, out, "id", spark.createDataFrame([("k3",), ("k4",), ("none",)], "id string"))
    ingest.delete_where_stored(spark, out, "id", Range("at", gte=9))
    assert [r[2] for r in sorted(_rows(spark, out), key=lambda r: r[2])] == [0, 1, 2, 5, 6, 7, 8]
    ingest.delete_where_stored(spark, out, "id", Range("at", gte=0))
    assert _rows(spark, out) == []
    ingest.upsert_rows(spark.createDataFrame([("z", "back", 1)], SCHEMA), out, "id", "at")
    assert _rows(spark, out) == [("z", "back", 1)]
    ingest.truncate_stored(spark, out)
    assert _rows(spark, out) == []


TIMED = "id string, text string, at timestamp"
T0 = dt.datetime(2024, 1, 1)


def _statistics(spark, out):
    return {r.term: (r.n_rows, r.n_terms) for r in statistics.read_statistics(spark, out).collect()}


def _keep(spark, tmp_path, **options):
    stream = spark.readStream.schema(TIMED).json(str(tmp_path / "src"))
    return _run(statistics.statistics_stream(stream, str(tmp_path / "out"), str(tmp_path / "chk"), id_col="id", text_col="text", **options))


def test_statistics_over_restarts_repeats_and_a_replay(spark, tmp_path):
    out = str(tmp_path / "out")
    _land(spark, tmp_path / "src", [("a", "Red red fox", T0), ("b", None, T0), ("c", "", T0), (None, "red", T0), ("a", "Red red fox", T0)], TIMED)
    _keep(spark, tmp_path)
    assert _statistics(spark, out) == {None: (3, 3), "red": (1, 2), "fox": (1, 1)}
    _land(spark, tmp_path / "src", [("a", "other words", T0), ("d", "fox hunt", T0)], TIMED)
    for _ in range(2):
        _keep(spark, tmp_path)
        assert _statistics(spark, out) == {None: (4, 5), "red": (1, 2), "fox": (2, 2), "hunt": (1, 1)}
        _lose_commit(tmp_path / "chk", 1)


def test_statistics_equal_those_of_a_batch(spark, tmp_path):
    rows = [(f"k{i % 150}", " ".join(f"w{i % 150 % n}" for n in range(1, 9)), T0) for i in range(400)]
    for part in (rows[:100], rows[100:250], rows[250:]):
        _land(spark, tmp_path / "src", part, TIMED)
        _keep(spark, tmp_path)
    whole = statistics.count_terms(spark.createDataFrame(rows, TIMED).dropDuplicates(["id"]), "text")
    assert _statistics(spark, str(tmp_path / "out")) == {r.term: (r.n_rows, r.n_terms) for r in whole.collect()}


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    for rows in ([("a", "one", T0)], [("b", "two", T0 + 48 * hour)], [("c", "late", T0 + hour), ("d", "in time", T0 + 47 * hour)]):
        _land(spark, tmp_path / "src", rows, TIMED)
        _keep(spark, tmp_path, time_col="at", delay="6 hours")
    assert _statistics(spark, str(tmp_path / "out")) == {None: (3, 4), "one": (1, 1), "two": (1, 1), "in": (1, 1), "time": (1, 1)}
