"""Postings by block of rows, with what bounds the gain of a term in each block.

Rows are dealt into blocks by the length of their text and, within a length, by a hash of their id, so the rows of one
block have nearly equal lengths. ``ranked`` has one row per (field, term, row id), sorted by (term, block): the rows of a
block stand together and are skipped together. ``blocks`` has one row per (field, term, block): the number of postings, the
largest frequency and the smallest length. Both bound the BM25 gain of the block whatever the average length has become.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.sources.postings import TermIndex

#: Rows of about one length per block, and lengths told apart per doubling.
BLOCK_ROWS = 128
CLASSES = 8


def block_of(length: Column, doc_id: Column, parts: int) -> Column:
    """The block of a row: its class of length, then one of ``parts`` by its id."""
    klass = F.floor(F.log2(F.greatest(length, F.lit(1))) * CLASSES)
    return klass * F.lit(parts) + F.pmod(F.xxhash64(doc_id), F.lit(parts))


class BlockIndex:
    def __init__(self, ranked: DataFrame, blocks: DataFrame):
        self.ranked, self.blocks = ranked, blocks

    @classmethod
    def build(cls, index: TermIndex, path: str, block_rows: int = BLOCK_ROWS, mode: str = "errorifexists") -> BlockIndex:
        """Write the blocks of a term index's postings under ``path``."""
        # Lengths spread over a few doublings, so about this many parts make blocks of the size asked for.
        rows = index.lengths.agg(F.max("n")).first()[0] or 0
        parts = max(1, rows // (block_rows * 2 * CLASSES))
        columns = ["field", "term", block_of(F.col("dl"), F.col("doc_id"), parts).alias("block"), "doc_id", "tf", "dl"]
        (
            index.postings.select(*columns).sortWithinPartitions("field", "term", "block", "doc_id")
            .write.mode(mode).partitionBy("field").parquet(f"{path}/ranked")
        )
        spark = index.postings.sparkSession
        (
            spark.read.parquet(f"{path}/ranked").groupBy("field", "term", "block")
            .agg(F.count(F.lit(1)).alias("n"), F.max("tf").alias("most"), F.min("dl").alias("least"))
            .sortWithinPartitions("field", "term", "block")
            .write.mode(mode).partitionBy("field").parquet(f"{path}/blocks")
        )
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BlockIndex:
        return cls(*[spark.read.parquet(f"{path}/{t}") for t in ("ranked", "blocks")])
