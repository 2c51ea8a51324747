"""Metric and bucket aggregations over matching rows."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.errors import RequestError
from textquarry.functions.analysis import field_slots
from textquarry.functions.values import epoch_millis, from_epoch_millis
from textquarry.operators.search import Relevance, sort_columns
from textquarry.plans.frames import matching, share
from textquarry.plans.query import Query
from textquarry.sources import fields as K
from textquarry.sources.corpus import Corpus
from textquarry.sources.scratch import scratch_path

DEFAULT_PERCENTS = (1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0)  # fixed values
COUNT = "doc_count"
#: Bucket lists up to this size are broadcast to restrict the rows of sub-aggregations.
BROADCAST_BUCKETS = 10_000
_GRID_BLOCK = 4096


@dataclass(frozen=True)
class Agg:
    name: str
    field: str


@dataclass(frozen=True)
class Sum(Agg): ...


@dataclass(frozen=True)
class Avg(Agg): ...


@dataclass(frozen=True)
class Min(Agg): ...


@dataclass(frozen=True)
class Max(Agg): ...


@dataclass(frozen=True)
class Count(Agg):
    """Number of values (not rows)."""


@dataclass(frozen=True)
class Stats(Agg):
    """``count, sum, min, max, avg`` in one struct."""


@dataclass(frozen=True)
class Cardinality(Agg):
    """Distinct values; a HyperLogLog++ sketch unless ``exact``."""

    exact: bool = False
    rsd: float = 0.02


@dataclass(frozen=True)
class Percentiles(Agg):
    """Map from percent text ("50.0") to value.

    A mergeable quantile summary by default. ``exact`` interpolates between
    values; its state grows with the number of distinct values per bucket.
    """

    percents: Sequence[float] = ()
    exact: bool = False
    accuracy: int = 10_000


@dataclass(frozen=True)
class Concat(Agg):
    """Values of the ``max_docs`` most relevant rows joined into one string."""

    max_docs: int = 1000
    separator: str = ", "


@dataclass(frozen=True)
class Terms(Agg):
    """The ``size`` most frequent values."""

    size: int = 10
    sub: Sequence[Agg] = ()


@dataclass(frozen=True)
class Histogram(Agg):
    """Fixed-width buckets keyed by lower bound; gaps are filled unless ``min_doc_count`` > 0."""

    interval: float = 1.0
    min_doc_count: int = 0
    sub: Sequence[Agg] = ()


@dataclass(frozen=True)
class DateHistogram(Agg):
    """Fixed time buckets such as "30s", "5m", "1h", "1d", optionally shifted."""

    fixed_interval: str = ""
    offset: str = "0s"
    min_doc_count: int = 0
    sub: Sequence[Agg] = ()


@dataclass(frozen=True)
class Bucket:
    """``low`` inclusive, ``high`` exclusive, either may be open."""

    low: float | None = None
    high: float | None = None
    key: str | None = None

    @property
    def label(self) -> str:
        if self.key is not None:
            return self.key
        low, high = ("*" if v is None else str(float(v)) for v in (self.low, self.high))
        return f"{low}-{high}"


@dataclass(frozen=True)
class Ranges(Agg):
    """Explicit numeric buckets; each requested one appears, empty or not."""

    buckets: Sequence[Bucket] = ()
    sub: Sequence[Agg] = ()


METRICS = (Sum, Avg, Min, Max, Count, Stats, Cardinality, Percentiles)
BUCKETS = (Terms, Histogram, DateHistogram, Ranges)


@dataclass
class Aggregations:
    """Result of one request.

    ``metrics``: one row, one column per top-level metric and concat, in request
    order. ``buckets``: one DataFrame per bucket aggregation, keyed by its dotted
    path ("by_day.by_type"), holding the keys of its parents, its own key,
    ``doc_count`` and a column per sub-metric.
    """

    metrics: DataFrame | None = None
    buckets: dict[str, DataFrame] = field(default_factory=dict)


def aggregate(corpus: Corpus, aggs: Sequence[Agg], query: Query | None = None,
              empty_as_null: bool = False) -> Aggregations:
    """Run several aggregations over the rows matching ``query``.

    All top-level metrics share one pass; every bucket level is one grouped
    aggregation that also computes its sub-metrics. Numeric metrics of nothing
    are 0.0 unless ``empty_as_null``.
    """
    for a in aggs:
        if not isinstance(a, (*METRICS, *BUCKETS, Concat)):
            raise RequestError(f"not an aggregation: {a!r}")
    names = [a.name for a in aggs]
    if len(set(names)) != len(names):
        raise RequestError(f"aggregation names must be unique: {names}")
    plan = _Plan(corpus, empty_as_null)
    for a in aggs:
        plan.check(a)
    reads = list(dict.fromkeys(f for a in aggs if not isinstance(a, Concat) for f in _fields(a)))
    out = Aggregations()
    rows = matching(corpus, query, columns=reads) if reads else None
    metrics = [a for a in aggs if isinstance(a, METRICS)]
    concats = [a for a in aggs if isinstance(a, Concat)]
    if metrics:
        out.metrics = plan.metrics(rows, [], metrics)
    if concats:
        joined = plan.concats(query, concats)
        if out.metrics is None:
            out.metrics = joined
        else:
            packed = joined.select(F.struct("*").alias("c"))
            out.metrics = out.metrics.withColumn("__c", packed.scalar()).select("*", "__c.*")
        out.metrics = out.metrics.select(*[n for n in names if n in out.metrics.columns])
    for a in aggs:
        if isinstance(a, BUCKETS):
            plan.bucket(rows, a, [], a.name, out.buckets)
    return out


def _fields(a: Agg) -> list[str]:
    return [a.field] + [f for s in getattr(a, "sub", ()) for f in _fields(s)]


def parse_duration(text: str) -> int:
    """Milliseconds of a duration such as "1h" or "-30m"."""
    units = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}  # fixed values
    m = re.fullmatch(r"([+-]?\d+)(ms|s|m|h|d)", text)
    if not m:
        raise RequestError(f"bad duration {text!r}; use a number and one of ms, s, m, h, d")
    return int(m.group(1)) * units[m.group(2)]


class _Plan:
    def __init__(self, corpus: Corpus, empty_as_null: bool):
        self.corpus, self.empty_as_null = corpus, empty_as_null

    # -- validation ------------------------------------------------------------

    def check(self, a: Agg, above: tuple[str, ...] = ()) -> None:
        nested = bool(above)
        if a.name in (COUNT, "from", "to", *above):
            raise RequestError(f"aggregation name {a.name!r} is taken")
        spec = self.corpus.spec(a.field)
        if isinstance(a, Concat):
            if nested:
                raise RequestError("concat cannot be a sub-aggregation")
            return
        if not isinstance(a, METRICS + BUCKETS):
            raise RequestError(f"not an aggregation: {a!r}")
        numeric = (Sum, Avg, Min, Max, Stats, Percentiles, Histogram, Ranges)
        if isinstance(a, numeric) and spec.kind not in K.NUMERIC_KINDS:
            raise RequestError(f"{type(a).__name__} needs a numeric field, {a.field!r} is {spec.kind}")
        if isinstance(a, DateHistogram):
            if spec.kind != K.DATE:
                raise RequestError(f"date histogram needs a date field, {a.field!r} is {spec.kind}")
            if not a.fixed_interval:
                raise RequestError(f"date histogram {a.name!r} needs a fixed_interval")
            if parse_duration(a.fixed_interval) <= 0:
                raise RequestError("fixed_interval must be positive")
        if isinstance(a, Histogram) and a.interval <= 0:
            raise RequestError("histogram interval must be positive")
        if isinstance(a, Ranges) and not a.buckets:
            raise RequestError(f"range {a.name!r} needs at least one bucket")
        subs = getattr(a, "sub", ())
        if len({s.name for s in subs}) != len(subs):
            raise RequestError(f"sub-aggregations of {a.name!r} must have different names")
        for s in subs:
            self.check(s, (*above, a.name))

    # -- metrics ---------------------------------------------------------------

    def _empty(self, column: Column) -> Column:
        return column if self.empty_as_null else F.coalesce(column, F.lit(0.0))

    def metric(self, a: Agg, exploded: bool = False) -> Column:
        """Aggregate expression of one metric."""
        spec = self.corpus.spec(a.field)
        value = F.col(f"`{a.field}`")
        if spec.multi and not exploded:
            arr = spec.values()
            count = F.coalesce(F.sum(F.size(arr)), F.lit(0))
            if isinstance(a, Count):
                return count
            numbers = F.transform(arr, lambda v: v.cast("double"))
            some = F.size(arr) > 0
            total = F.sum(F.when(some, F.aggregate(numbers, F.lit(0.0), lambda x, y: x + y)))
            low, high = F.min(F.array_min(numbers)), F.max(F.array_max(numbers))
        else:
            number = value.cast("double")
            count, total, low, high = F.count(value), F.sum(number), F.min(number), F.max(number)
        mean = total / F.nullif(count, F.lit(0).cast("bigint"))
        if isinstance(a, Sum):
            return self._empty(total)
        if isinstance(a, Avg):
            return self._empty(mean)
        if isinstance(a, Min):
            return self._empty(low)
        if isinstance(a, Max):
            return self._empty(high)
        if isinstance(a, Count):
            return count
        if isinstance(a, Stats):
            return F.struct(
                count.alias("count"), self._empty(total).alias("sum"), self._empty(low).alias("min"),
                self._empty(high).alias("max"), self._empty(mean).alias("avg"),
            )
        if isinstance(a, Cardinality):
            return F.count_distinct(value) if a.exact else F.approx_count_distinct(value, a.rsd)
        percents = [float(p) for p in (a.percents or DEFAULT_PERCENTS)]
        shares = F.array(*[F.lit(p / 100.0) for p in percents])
        points = F.percentile_approx(value.cast("double"), shares, a.accuracy)
        keys = F.array(*[F.lit(str(p)) for p in percents])
        return F.when(points.isNotNull(), F.map_from_arrays(keys, points))

    def exact_percentiles(self, rows: DataFrame, keys: list[str], a: Percentiles) -> DataFrame:
        """Interpolated percentiles without holding a group's values anywhere.

        A sketch brackets each percentile; the values below the bracket are counted, and only the few distinct ones inside
        it are ordered. Its neighbours on both sides are kept for brackets that miss a rank by one.
        """
        spec, accuracy = self.corpus.spec(a.field), 10_000
        percents = [float(p) for p in (a.percents or DEFAULT_PERCENTS)]
        number = (F.explode(spec.values()) if spec.multi else spec.column).alias("__v")
        values = rows.select(*keys, number).select(*keys, F.col("__v").cast("double").alias("__v")).where("__v IS NOT NULL")
        v = F.col("__v")
        at = lambda shift: F.percentile_approx(v, F.array(*[F.lit(min(1.0, max(0.0, p / 100 + shift))) for p in percents]), accuracy)
        bounds = values.groupBy(*keys).agg(F.struct(F.count("*").alias("n"), at(-2 / accuracy).alias("lo"), at(2 / accuracy).alias("hi")).alias("__b"))
        near = values.join(bounds, keys) if keys else values.withColumn("__b", bounds.scalar())
        lo, hi = (lambda i: F.col("__b.lo")[i]), (lambda i: F.col("__b.hi")[i])
        spots = range(len(percents))
        sides = near.groupBy(*keys).agg(F.any_value("__b.n").alias("__n"), F.array(*[
            F.struct(F.count_if(v < lo(i)).alias("below"), F.max(F.when(v < lo(i), v)).alias("before"), F.min(F.when(v > hi(i), v)).alias("after")) for i in spots
        ]).alias("__sides"))
        held = F.array_compact(F.array(*[F.when((v >= lo(i)) & (v <= hi(i)), F.lit(i)) for i in spots]))
        inside = near.select(*keys, F.explode(held).alias("__i"), "__v").groupBy(*keys, "__i", "__v").agg(F.count("*").alias("__c"))
        upto = F.sum("__c").over(W.partitionBy(*keys, "__i").orderBy("__v"))
        placed = inside.withColumn("__upto", upto)
        placed = placed.join(sides, keys) if keys else placed.withColumn("__s", sides.select(F.struct("*").alias("s")).scalar()).select("*", "__s.*")
        side = F.col("__sides")[F.col("__i")]
        place = (F.col("__n") - 1) * F.get(F.array(*[F.lit(p / 100) for p in percents]), F.col("__i"))
        last = F.col("__upto") + side["below"]

        def value_at(rank: Column) -> Column:
            return F.coalesce(F.max(F.when(rank < side["below"], side["before"])), F.min(F.when(last > rank, v)), F.max(side["after"]))

        low, high = F.floor(place), F.ceil(place)
        point = placed.groupBy(*keys, "__i").agg(value_at(low).alias("a"), value_at(high).alias("b"), F.max(place).alias("p"))
        low, high = F.floor("p"), F.ceil("p")
        shown = F.when(low == high, F.col("a")).otherwise((high - F.col("p")) * F.col("a") + (F.col("p") - low) * F.col("b"))
        listed = F.array_sort(F.collect_list(F.struct("__i", shown.alias("x"))))
        names = F.array(*[F.lit(str(p)) for p in percents])
        found = point.groupBy(*keys).agg(listed.alias("__l"))
        return found.select(*keys, F.when(F.size("__l") > 0, F.map_from_arrays(names, F.col("__l.x"))).alias(a.name))

    def metrics(self, rows: DataFrame, keys: list[str], metrics: Sequence[Agg], counted: bool = False) -> DataFrame:
        """One grouped pass; sketches over multi-valued fields need one of their own each.

        So do exact distinct values of all rows beside sketches: in one pass every value would carry sketches of its rows.
        """
        sketched = any(isinstance(a, (Cardinality, Percentiles)) and not a.exact for a in metrics)
        apart = [
            a for a in metrics
            if isinstance(a, (Cardinality, Percentiles)) and (self.corpus.spec(a.field).multi or getattr(a, "exact", False) and isinstance(a, Percentiles))
            or not keys and sketched and isinstance(a, Cardinality) and a.exact
        ]
        together = [self.metric(a).alias(a.name) for a in metrics if a not in apart]
        if counted:
            together.insert(0, F.count(F.lit(1)).alias(COUNT))
        out = rows.groupBy(*keys).agg(*together) if together else None
        for a in apart:
            if isinstance(a, Percentiles) and a.exact:
                one = self.exact_percentiles(rows, keys, a)
            elif not self.corpus.spec(a.field).multi:
                one = rows.agg(self.metric(a).alias(a.name))
            else:
                values = rows.select(*keys, F.explode(self.corpus.spec(a.field).values()).alias(a.field))
                one = values.groupBy(*keys).agg(self.metric(a, exploded=True).alias(a.name))
            if out is None:
                out = one
            elif keys:
                out = out.join(one, keys, "left")
            else:
                out = out.withColumn(a.name, one.scalar())
        order = [*keys, *([COUNT] if counted else []), *[a.name for a in metrics]]
        return out.select(*[f"`{c}`" for c in order])

    def concats(self, query: Query | None, concats: Sequence[Concat]) -> DataFrame:
        """One shared top-k; the strings hold at most ``max_docs`` rows by definition."""
        corpus = self.corpus
        order, reads, _ = sort_columns(corpus, [Relevance()])
        most = max(1, *[c.max_docs for c in concats])
        columns = list(dict.fromkeys([*reads, *[c.field for c in concats]]))
        rows = matching(corpus, query, scored=True, columns=columns)
        top = rows.orderBy(*order).limit(most).withColumn("__rank", F.row_number().over(W.orderBy(*order)))
        out = []
        for c in concats:
            spec = corpus.spec(c.field)
            if spec.kind in K.CONCAT_KINDS:
                shown = _texts(spec)
                held = F.array_sort(F.collect_list(
                    F.when(F.col("__rank") <= c.max_docs, F.struct("__rank", shown.alias("v")))
                ))
                text = F.array_join(F.flatten(F.transform(held, lambda e: e["v"])), c.separator)
            else:
                text = F.lit("")
            out.append(F.coalesce(text, F.lit("")).alias(c.name))
        return top.agg(*out)

    # -- buckets ---------------------------------------------------------------

    def keyed(self, rows: DataFrame, a: Agg, name: str) -> DataFrame:
        """Rows with the bucket key of ``a`` as ``name``; a row may fall into several buckets or none."""
        spec = self.corpus.spec(a.field)
        if isinstance(a, Terms):
            if spec.kind == K.TEXT:
                key = F.explode(F.array_distinct(field_slots(spec)))
            elif spec.multi:
                key = F.explode(F.array_distinct(spec.values()))
            else:
                key = spec.column
            return rows.select("*", key.alias(name)).where(F.col(name).isNotNull())
        if spec.multi:
            rows = rows.select("*", F.explode(spec.values()).alias("__v"))
        else:
            rows = rows.withColumn("__v", spec.column).where(F.col("__v").isNotNull())
        value = F.col("__v")
        if not isinstance(a, Ranges) or _apart(a):  # at most one bucket a value
            return rows.withColumn(name, self.key_of(a, value)).where(F.col(name).isNotNull()).drop("__v")
        return rows.select("*", F.explode(F.array_compact(F.array(*self._hits(a, value)))).alias(name)).drop("__v")

    def key_of(self, a: Agg, value: Column) -> Column:
        """The bucket of one value, NULL outside all buckets (``Ranges`` must not overlap)."""
        if isinstance(a, Terms):
            return value
        if isinstance(a, Histogram):
            place = value.cast("double") / a.interval
            return F.when(F.abs(place) < 2.0 ** 63, F.floor(place))
        if isinstance(a, DateHistogram):
            step, shift = parse_duration(a.fixed_interval), parse_duration(a.offset)
            return F.floor((epoch_millis(value, self.corpus.spec(a.field).element_type) - shift) / F.lit(step))
        return F.coalesce(*self._hits(a, value))

    @staticmethod
    def _hits(a: Ranges, value: Column) -> list[Column]:
        """Per range its number where the value lies in it."""
        number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))

        def fits(i: int, b) -> Column:
            tests = [number.isNotNull()]
            tests += [number >= F.lit(float(b.low))] if b.low is not None else []
            tests += [number < F.lit(float(b.high))] if b.high is not None else []
            return F.when(reduce(lambda x, y: x & y, tests), F.lit(i))

        return [fits(i, b) for i, b in enumerate(a.buckets)]

    @staticmethod
    def bucket_list(a: Ranges) -> Column:
        return F.array(*[
            F.struct(
                F.lit(i).alias("pos"), F.lit(b.label).alias("key"),
                F.lit(b.low).cast("double").alias("from"), F.lit(b.high).cast("double").alias("to"),
            )
            for i, b in enumerate(a.buckets)
        ])

    def bucket(self, rows: DataFrame, a: Agg, parents: list[str], path: str, out: dict[str, DataFrame]) -> None:
        """``parents`` are the names of the enclosing aggregations; their keys are columns ``__k0, __k1, ...``."""
        outer = [f"__k{i}" for i in range(len(parents))]
        own_key = f"__k{len(parents)}"
        keys = [*outer, own_key]
        keyed = self.keyed(rows, a, own_key)
        own = [s for s in a.sub if isinstance(s, METRICS)]
        counts = self.metrics(keyed, keys, own, counted=True)
        if isinstance(a, Terms):
            counts = self._largest(counts, a, outer, own_key)
        shown = self._shown(counts, a, outer, own_key, own)
        names = [*parents, a.name]
        out[path] = shown.withColumnsRenamed(dict(zip(keys, names)))
        nested = [s for s in a.sub if isinstance(s, BUCKETS)]
        if nested and isinstance(a, Terms):  # only rows of the surviving buckets go on
            alive = counts.select(*keys)
            small = not parents and a.size <= BROADCAST_BUCKETS
            keyed = keyed.join(F.broadcast(alive) if small else alive, keys, "left_semi")
        value = self._key_value(a, own_key)
        for s in nested:
            self.bucket(keyed.withColumn(own_key, value), s, names, f"{path}.{s.name}", out)

    @staticmethod
    def _largest(counts: DataFrame, a: Terms, outer: list[str], key: str) -> DataFrame:
        order = [F.desc(COUNT), F.asc(key)]
        if not outer:
            return counts.orderBy(*order).limit(a.size)
        pos = F.row_number().over(W.partitionBy(*outer).orderBy(*order))
        return counts.withColumn("__pos", pos).where(F.col("__pos") <= a.size).drop("__pos")

    def _key_value(self, a: Agg, name: str) -> Column:
        """What a bucket number stands for."""
        key = F.col(name)
        if isinstance(a, Histogram):
            return key * F.lit(float(a.interval))
        if isinstance(a, DateHistogram):
            step, shift = parse_duration(a.fixed_interval), parse_duration(a.offset)
            return from_epoch_millis(key * step + shift, self.corpus.spec(a.field).element_type)
        if isinstance(a, Ranges):
            return F.get(self.bucket_list(a), key)["key"]
        return key

    def _shown(self, counts: DataFrame, a: Agg, outer: list[str], key: str, own: Sequence[Agg]) -> DataFrame:
        """Fill empty buckets and turn bucket numbers into key values."""
        if isinstance(a, Terms):
            return counts
        if isinstance(a, Ranges):
            counts = share(counts) if outer else counts
            joined = self._all_ranges(counts, a, outer, key).join(counts, [*outer, key], "left")
        elif a.min_doc_count == 0:
            counts = share(counts)
            joined = self._grid(counts, key, outer).join(counts, [*outer, key], "left")
        else:
            joined = counts.where(F.col(COUNT) >= a.min_doc_count)
        filled = [F.coalesce(F.col(COUNT), F.lit(0)).alias(COUNT)]
        filled += [self._fill(m).alias(m.name) for m in own]
        extra = ["from", "to"] if isinstance(a, Ranges) else []
        return joined.select(*outer, self._key_value(a, key).alias(key), *[f"`{e}`" for e in extra], *filled)

    def _fill(self, m: Agg) -> Column:
        """Value of a metric in a bucket that no row fell into."""
        col = F.col(f"`{m.name}`")
        if isinstance(m, (Count, Cardinality)):
            return F.coalesce(col, F.lit(0))
        if self.empty_as_null and not isinstance(m, Stats):
            return col
        if isinstance(m, Stats):
            zero = F.lit(None if self.empty_as_null else 0.0).cast("double")
            return F.coalesce(col, F.struct(
                F.lit(0).cast("bigint").alias("count"), zero.alias("sum"), zero.alias("min"),
                zero.alias("max"), zero.alias("avg"),
            ))
        return col if isinstance(m, Percentiles) else F.coalesce(col, F.lit(0.0))

    @staticmethod
    def _grid(counts: DataFrame, key: str, parents: list[str]) -> DataFrame:
        """Every bucket number between the first and last of each parent.

        Numbers are produced in blocks, so no array grows with the span.
        """
        bounds = counts.groupBy(*parents).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        bounds = bounds.where(F.col("lo").isNotNull())
        blocks = bounds.select(
            *parents, "hi", F.explode(F.sequence("lo", "hi", F.lit(_GRID_BLOCK).cast("bigint"))).alias("at")
        )
        last = F.least(F.col("hi"), F.col("at") + _GRID_BLOCK - 1)
        return blocks.select(*parents, F.explode(F.sequence(F.col("at"), last)).alias(key))

    def _all_ranges(self, counts: DataFrame, a: Ranges, parents: list[str], key: str) -> DataFrame:
        """The requested buckets, once or once per parent bucket."""
        if parents:
            heads = counts.select(*parents).distinct()
        else:
            heads = self.corpus.spark.range(1)
        listed = heads.select(*parents, F.explode(self.bucket_list(a)).alias("b"))
        return listed.select(*parents, F.col("b.pos").alias(key), F.col("b.from"), F.col("b.to"))


def _apart(a: Ranges) -> bool:
    """Whether no value lies in two ranges."""
    ends = sorted((b.low if b.low is not None else -math.inf, b.high if b.high is not None else math.inf) for b in a.buckets)
    return all(high <= low for (_, high), (low, _) in zip(ends, ends[1:]))


def aggregate_together(corpus: Corpus, aggs: Sequence[Agg], query: Query | None = None, empty_as_null: bool = False) -> dict[str, DataFrame]:
    """The buckets of several bucket aggregations and all their levels from one pass over the matching rows.

    Results are those of ``aggregate(...).buckets``. Every level is a grouping set of one aggregation, so rows are read and
    shuffled once, reduced before the shuffle. That job runs at once and leaves the groups in the scratch folder; sizes, ranks
    and gaps are worked out on them, however many levels are then looked at. A field with several
    values, analysed text, overlapping ranges and exact percentiles put a row into several groups of a level or need a pass of
    their own: such requests go to ``aggregate``.
    """
    plan = _Plan(corpus, empty_as_null)
    nodes: list[tuple[str, Agg, list[int]]] = []  # path, aggregation, its ancestors' numbers

    def add(a: Agg, path: str, above: list[int]) -> None:
        spec = corpus.spec(a.field)
        if spec.multi or spec.kind == K.TEXT or (isinstance(a, Ranges) and not _apart(a)):
            raise RequestError(f"{a.name!r} can put a row into several buckets; use aggregate")
        if any(isinstance(s, Percentiles) and s.exact for s in a.sub):
            raise RequestError("exact percentiles need passes of their own; use aggregate")
        nodes.append((path, a, above))
        own = [*above, len(nodes) - 1]
        for s in a.sub:
            if isinstance(s, BUCKETS):
                add(s, f"{path}.{s.name}", own)

    if len({a.name for a in aggs}) != len(aggs):
        raise RequestError("aggregation names must be unique")
    for a in aggs:
        if not isinstance(a, BUCKETS):
            raise RequestError(f"not a bucket aggregation: {a!r}")
        plan.check(a)
        add(a, a.name, [])
    if not nodes:
        return {}
    keys = [f"__n{i}" for i in range(len(nodes))]
    rows = matching(corpus, query, columns=list(dict.fromkeys(f for a in aggs for f in _fields(a))))
    rows = rows.withColumns({k: plan.key_of(a, corpus.spec(a.field).column) for k, (_, a, _) in zip(keys, nodes)})
    sets = [[F.col(keys[i]) for i in [*above, n]] for n, (_, _, above) in enumerate(nodes)]
    metrics = {f"__m{n}_{s.name}": s for n, (_, a, _) in enumerate(nodes) for s in a.sub if isinstance(s, METRICS)}
    grouped = rows.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias(COUNT), *[plan.metric(s).alias(m) for m, s in metrics.items()])
    path = scratch_path(corpus.spark, "groups")
    grouped.write.parquet(path)
    grouped = corpus.spark.read.schema(grouped.schema).parquet(path)
    out, alive = {}, {}
    for n, (path, a, above) in enumerate(nodes):
        chain = [*above, n]
        number = sum(1 << (len(nodes) - 1 - i) for i in range(len(nodes)) if i not in chain)
        own = [s for s in a.sub if isinstance(s, METRICS)]
        counts = grouped.where((F.col("__set") == number) & reduce(lambda x, y: x & y, [F.col(keys[i]).isNotNull() for i in chain]))
        counts = counts.select(*[F.col(keys[i]).alias(f"__k{j}") for j, i in enumerate(chain)], COUNT, *[F.col(f"__m{n}_{s.name}").alias(s.name) for s in own])
        outer, own_key = [f"__k{j}" for j in range(len(above))], f"__k{len(above)}"
        if above and above[-1] in alive:
            counts = counts.join(alive[above[-1]], outer, "left_semi")
        if isinstance(a, Terms):
            counts = plan._largest(counts, a, outer, own_key)
        if isinstance(a, Terms) or (above and above[-1] in alive):
            alive[n] = counts.select(*outer, own_key)
        shown = counts.select(*[plan._key_value(nodes[i][1], f"__k{j}").alias(f"__k{j}") for j, i in enumerate(above)], own_key, COUNT, *[s.name for s in own])
        shown = plan._shown(shown, a, outer, own_key, own)
        out[path] = shown.withColumnsRenamed({f"__k{j}": nodes[i][1].name for j, i in enumerate(chain)})
    return out


def _texts(spec: K.FieldSpec) -> Column:
    """Values as concat prints them."""
    def shown(v: Column) -> Column:
        if spec.kind == K.F64:
            return F.regexp_replace(v.cast("string"), r"\.0$", "")
        if spec.kind == K.IP:  # the stored form is IPv6
            return F.when(v.contains(":"), v).otherwise(F.concat(F.lit("::ffff:"), v))
        return v.cast("string")

    return F.transform(spec.values(), shown)
