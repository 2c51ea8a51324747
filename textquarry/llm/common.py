"""Session helpers shared by the operators: the shared folder, stored intermediate tables, document rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Between words: all of ASCII but digits and a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a temporary one only where none is set."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(f"file://{tempfile.mkdtemp(prefix='textquarry-')}")
    return _own[0]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z, every other character stays (``lower`` would change more)."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Maximal runs of digits, a-z and characters outside ASCII, after lower-casing A-Z."""
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def doc_rows(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (long), ``th`` and ``text`` (null: empty) with the columns ``more``; other columns fall away.

    (doc_id, th) names a row: two rows that share both are equal, and equal rows get equal results.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"), *[docs[c] for c in more])
