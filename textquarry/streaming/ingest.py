"""Keeping stored corpora up to date from streams, with ``foreachBatch`` over Parquet folders.

An appended corpus holds one folder per stream and batch. A batch that Spark replays after a failure overwrites its own
folder, so it is there once, and any number of streams may share a path.

An upserted corpus is partitioned by a hash of the id. A batch merges its rows with the stored rows of the id buckets it
touches and overwrites these partitions. Of equal ids the row with the largest ``order_by`` stays, stored rows included,
and of equal ones the new row: a replayed batch changes nothing, a late row does not replace a newer one. One stream may
write to a path at a time. Parquet folders have no atomic replacement: a reader during a write may see either state of a
bucket, and a writer that dies while Spark moves finished files into place can lose that bucket. Where that matters, let
the same batch function write to a transactional table format.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textquarry.errors import RequestError
from textquarry.plans.query import Query
from textquarry.plans.frames import matching
from textquarry.sources.corpus import Corpus
from textquarry.sources.maintain import latest

STREAM, BATCH = "__stream", "__batch"
#: The partition column's name ends in the number of buckets, so a corpus cannot be written with two.
BUCKET = "__bucket_of_"
BUCKETS = 64


def stream_name(checkpoint: str) -> str:
    """The identity of a stream: its checkpoint, which holds its batch numbers."""
    return "s" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def run_batches(stream: DataFrame, write, checkpoint: str, mode: str = "append", **trigger) -> StreamingQuery:
    """``write(batch, number)`` for every micro-batch; by default until all that is there now is done."""
    batches = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return batches.trigger(**(trigger or {"availableNow": True})).start()


def append_stream(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Add every micro-batch, once."""
    own = f"{path}/{STREAM}={stream_name(checkpoint)}"
    return run_batches(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{own}/{BATCH}={n}"), checkpoint, **trigger)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the finished batches."""
    return spark.read.parquet(path).drop(STREAM, BATCH)


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, str] | None:
    """The stored rows and their bucket column; nothing where no batch has been written."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows, next(c for c in rows.columns if c.startswith(BUCKET))


def _existing(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    stored = _stored(spark, path)
    if stored is None:
        raise RequestError(f"nothing is stored at {path}")
    return stored


def _bucket(id_col: str, name: str):
    return F.pmod(F.xxhash64(id_col), F.lit(int(name.removeprefix(BUCKET)))).cast("int").alias(name)


def _replace(rows: DataFrame, path: str, bucket: str) -> None:
    """``rows`` become the whole content of the buckets they fall into."""
    rows.hint("rebalance", bucket).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path)


def upsert_rows(rows: DataFrame, path: str, id_col: str, order_by: str, buckets: int | None = None) -> None:
    """Insert or replace by id; the first write fixes the number of buckets. A batch without rows changes nothing."""
    stored = _stored(rows.sparkSession, path)
    name = stored[1] if stored else f"{BUCKET}{buckets or BUCKETS}"
    if buckets is not None and name != f"{BUCKET}{buckets}":
        raise RequestError(f"this corpus is stored in {name.removeprefix(BUCKET)} buckets, not {buckets}")
    rows = rows.persist()
    try:
        fresh = rows.select("*", _bucket(id_col, name), F.lit(1).alias("__new"))
        if stored:
            touched = [r[0] for r in fresh.select(name).distinct().collect()]  # at most as many numbers as buckets
            if not touched:
                return
            fresh = stored[0].where(F.col(name).isin(touched)).withColumn("__new", F.lit(0)).unionByName(fresh)
        kept = latest(fresh.withColumn("__order", F.struct(order_by, "__new")), id_col, "__order").drop("__order", "__new")
        _replace(kept, path, name)
    finally:
        rows.unpersist()


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, *, id_col: str, order_by: str,
                  buckets: int | None = None, **trigger) -> StreamingQuery:
    """Insert or replace by id from a stream. Choose ``buckets`` so that one is a few hundred MB."""
    return run_batches(stream, lambda batch, _: upsert_rows(batch, path, id_col, order_by, buckets), checkpoint, **trigger)


def open_upserted(spark: SparkSession, path: str, id_col: str, seq_col: str | None = None, fields: dict | None = None) -> Corpus:
    """The stored corpus."""
    rows, bucket = _existing(spark, path)
    return Corpus(rows.drop(bucket), id_col, fields, seq_col=seq_col, unique_ids=True)


def delete_stored(spark: SparkSession, path: str, id_col: str, ids: DataFrame) -> None:
    """Remove the rows whose id is among ``ids`` (a table with the id column)."""
    rows, bucket = _existing(spark, path)
    gone = ids.select(F.col(id_col).alias("__gone")).distinct()
    met = rows.join(gone, F.col(id_col) == F.col("__gone"), "left").select(bucket, F.col("__gone").isNotNull().alias("hit"))
    counts = met.groupBy(bucket).agg(F.count_if("hit").alias("hit"), F.count_if(~F.col("hit")).alias("left")).where("hit > 0").collect()
    kept = rows.where(F.col(bucket).isin([r[bucket] for r in counts if r.left])).join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
    if any(r.left for r in counts):
        _replace(kept, path, bucket)
    _empty(rows, path, bucket, [r[bucket] for r in counts if not r.left])


def _empty(rows: DataFrame, path: str, bucket: str, numbers: list[int]) -> None:
    """Leave these buckets without rows; the schema stays."""
    for n in numbers:  # at most as many as there are buckets
        rows.drop(bucket).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/{bucket}={n}")


def delete_where_stored(spark: SparkSession, path: str, id_col: str, query: Query, fields: dict | None = None) -> None:
    """Remove the rows that match ``query``."""
    delete_stored(spark, path, id_col, matching(open_upserted(spark, path, id_col, fields=fields), query, columns=[id_col]))


def truncate_stored(spark: SparkSession, path: str) -> None:
    """Remove every row; the schema stays."""
    rows, bucket = _existing(spark, path)
    _empty(rows, path, bucket, [r[0] for r in rows.select(bucket).distinct().collect()])
