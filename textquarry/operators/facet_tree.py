"""Facets as nested intervals: totals of all levels at once, drill-down as a range of integers.

Every path that occurs, every level above one and the root get a number in preorder and the number of their last
descendant, so that what lies below a path is a range of numbers. Rows are stored with the numbers of their paths, sorted
by number: a drill-down reads the row groups of its range.

Totals need no row per level. Each path of a row counts one at its own number; neighbouring paths of one row count minus
one where their branches meet, so that a row with several paths below a node counts once there. After one running sum
over the numbers, the total of any node is a difference of two sums.

Defined cases: null paths are left out, empty segments too (``/a//b`` is ``/a/b``); a path without segments is the root;
a path that a row holds twice counts once. The corpus needs unique ids; a row without an id is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textquarry.errors import RequestError
from textquarry.functions.values import facet_path
from textquarry.plans.frames import matching
from textquarry.plans.query import Query
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import FACET

#: Numbers per block of the running sum; sums of blocks are added up on their own.
BLOCK = 1 << 16
NODES = "segments array<string>, label string, depth int, pre long, last long"
PLACES = "pre long, meets long"


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def _meet(a: Column, b: Column) -> Column:
    """The longest common beginning of two arrays of segments."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    differ = F.array_position(same, False)
    return F.slice(a, F.lit(1), F.when(differ > 0, differ - 1).otherwise(F.least(F.size(a), F.size(b))).cast("int"))


def _numbered(segments: DataFrame, scratch: str) -> DataFrame:
    """``segments`` (distinct) with ``pre``: sorted by ranges, counted per range, no task sees them all."""
    spark = segments.sparkSession
    ordered = segments.repartitionByRange("segments").sortWithinPartitions("segments").withColumn("id", F.monotonically_increasing_id())
    ordered.write.parquet(scratch)
    ordered = spark.read.schema("segments array<string>, id long").parquet(scratch)
    ordered = ordered.select("segments", F.shiftright("id", 33).alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("at"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # over one row per range
    starts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ordered.join(F.broadcast(starts), "part").select("segments", (F.col("start") + F.col("at")).alias("pre"))


class FacetTree:
    """``nodes``: label, depth, pre and last of every level; ``places``: id, pre and where a row's path meets its last one."""

    def __init__(self, corpus: Corpus, field: str, path: str):
        self.corpus, self.field = corpus, field
        key = corpus.df.schema[corpus.key()].dataType.simpleString()
        self.nodes = corpus.spark.read.schema(NODES).parquet(f"{path}/nodes")
        self.places = corpus.spark.read.schema(f"`{corpus.key()}` {key}, {PLACES}").parquet(f"{path}/places")

    @classmethod
    def build(cls, corpus: Corpus, field: str, path: str) -> FacetTree:
        """Number the levels of a facet field and write them and the rows' numbers under ``path``."""
        spec = corpus.spec(field)
        if spec.kind != FACET:
            raise RequestError(f"{field!r} is not a facet field")
        if not corpus.unique_ids:
            raise RequestError("a facet tree needs a corpus whose ids are declared unique")
        key = F.col(f"`{corpus.key()}`")
        paths = spec.column if spec.multi else F.array(spec.column)
        held = F.array_sort(F.array_distinct(F.transform(F.filter(paths, lambda p: p.isNotNull()), _segments)))
        rows = corpus.df.where(key.isNotNull()).select(key.alias("id"), held.alias("held"))
        single = rows.select("id", F.posexplode("held").alias("at", "segments"), "held")
        single = single.select("id", "segments", F.when(F.col("at") > 0, _meet(F.get("held", F.col("at") - 1), F.col("segments"))).alias("meets"))

        found = single.select("segments").distinct()
        levels = found.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("segments")), lambda n: F.slice("segments", F.lit(1), n))).alias("segments"))
        root = corpus.spark.range(1).select(F.array().cast("array<string>").alias("segments"))
        numbered = _numbered(levels.unionByName(root).distinct(), f"{path}/order")
        above = numbered.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("segments")), lambda n: F.slice("segments", F.lit(1), n))).alias("segments"))
        below = above.groupBy("segments").agg(F.count(F.lit(1)).alias("n"))
        label = F.concat(F.lit("/"), F.array_join("segments", "/"))
        nodes = numbered.join(below, "segments").select(
            "segments", label.alias("label"), F.size("segments").alias("depth"), "pre", (F.col("pre") + F.col("n") - 1).alias("last"))
        nodes.write.parquet(f"{path}/nodes")
        nodes = corpus.spark.read.schema(NODES).parquet(f"{path}/nodes")

        number = lambda c: nodes.select(F.col("segments").alias(c), F.col("pre").alias(f"n_{c}"))
        places = single.join(number("segments"), "segments").join(number("meets"), "meets", "left")
        places = places.select(F.col("id").alias(corpus.key()), F.col("n_segments").alias("pre"), F.col("n_meets").alias("meets"))
        places.repartitionByRange("pre", corpus.key()).sortWithinPartitions("pre", corpus.key()).write.parquet(f"{path}/places")
        return cls(corpus, field, path)

    def under(self, path=(), only_this_level: bool = False) -> DataFrame:
        """The ids of the rows with a path at or below ``path``: a range of numbers that reaches the scan."""
        node = self.nodes.where(F.col("label") == facet_path(path))
        first, last = node.agg(F.max("pre")).scalar(), node.agg(F.max("pre" if only_this_level else "last")).scalar()
        return self.places.where((F.col("pre") >= first) & (F.col("pre") <= last)).select(f"`{self.corpus.key()}`").distinct()

    def totals(self, query: Query | None = None) -> DataFrame:
        """``label, depth, count, child_count``: rows at or below every level that has any, the root (depth 0) included."""
        places, key = self.places, self.corpus.key()
        if query is not None:
            places = places.join(matching(self.corpus, query, columns=[key]), key, "left_semi")
        change = F.array(F.struct(F.col("pre"), F.lit(1).alias("n")), F.struct(F.col("meets").alias("pre"), F.lit(-1).alias("n")))
        changes = places.select(F.explode(change).alias("c")).select("c.*").where("pre IS NOT NULL").groupBy("pre").agg(F.sum("n").alias("n"))
        block = F.floor(F.col("pre") / BLOCK)
        own = self.nodes.join(changes, "pre", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("block", block)
        before = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # over one row per block
        blocks = own.groupBy("block").agg(F.sum("n").alias("b")).select("block", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("start"))
        inside = F.sum("n").over(W.partitionBy("block").orderBy("pre"))
        summed = own.withColumn("inside", inside).join(F.broadcast(blocks), "block").withColumn("sum", F.col("start") + F.col("inside"))
        ends = summed.select(F.col("pre").alias("last"), F.col("sum").alias("end"))
        counted = summed.join(ends, "last").withColumn("count", F.col("end") - F.col("sum") + F.col("n")).where("count > 0")
        children = counted.where("depth > 0").groupBy(F.slice("segments", F.lit(1), F.col("depth") - 1).alias("segments")).agg(F.count(F.lit(1)).alias("child_count"))
        return counted.join(children, "segments", "left").select("label", "depth", "count", F.coalesce("child_count", F.lit(0)).alias("child_count"))
