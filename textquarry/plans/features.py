"""What a query tree needs to know about each row, and how to compute it.

A query registers features (term frequency, phrase frequency, "some token
satisfies this test", field length) and statistics (document counts, average
lengths). They are computed either by analysing the text in one pass over the
rows (``scan_frame``) or from a stored term index (``TermIndex.frame``); the
match and score columns built on top are the same in both cases.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.analysis import field_slots
from textquarry.plans.scoring import idf_sql
from textquarry.plans.terms import bind, token_count
from textquarry.sources.corpus import Corpus, spread
from textquarry.sources.patterns import Needed

STATS = "__stats"
MANY_TERMS = 4


@dataclass(frozen=True)
class PhraseSpec:
    field: str
    terms: tuple[str, ...]
    slop: int = 0
    prefix: bool = False          # the last term is a prefix
    expansions: str | None = None  # lookup column holding the allowed last terms

    def last_fits(self, term: Column) -> Column:
        if self.expansions:
            return F.array_contains(F.col(self.expansions), term)
        return term.startswith(self.terms[-1])

    def fits(self, k: int, term: Column) -> Column:
        if self.prefix and k == len(self.terms) - 1:
            return self.last_fits(term)
        return term == self.terms[k]


class Features:
    def __init__(self, corpus: Corpus):
        self.corpus = corpus
        self.terms: dict[tuple[str, str], str] = {}
        self.tests: dict[str, tuple[str, Callable[[Column], Column]]] = {}
        self.phrases: dict[PhraseSpec, str] = {}
        self.lengths: dict[str, str] = {}
        self.needed: dict[str, Needed] = {}  # what a dictionary entry passing the test must have
        self.lookups: dict[str, DataFrame] = {}
        self.sets: dict[str, tuple[str, DataFrame]] = {}
        self.term_stats: dict[tuple[str, str], str] = {}
        self.length_stats: dict[str, str] = {}
        self.row_stats: dict[str, tuple[Column, Column]] = {}

    # -- registration ----------------------------------------------------------

    def tf(self, field: str, term: str) -> str:
        return self.terms.setdefault((field, term), f"__t{len(self.terms)}")

    def test(self, field: str, predicate: Callable[[Column], Column], needed: Needed | None = None) -> Column:
        name = f"__m{len(self.tests)}"
        self.tests[name] = (field, predicate)
        if needed is not None:
            self.needed[name] = needed
        return F.col(name)

    def phrase(self, spec: PhraseSpec) -> str:
        return self.phrases.setdefault(spec, f"__p{len(self.phrases)}")

    def length(self, field: str) -> str:
        return self.lengths.setdefault(field, f"__len{len(self.lengths)}")

    def lookup(self, frame: DataFrame) -> str:
        """Attach a one-row, one-column result (a scalar subquery) to every row."""
        name = f"__x{len(self.lookups)}"
        self.lookups[name] = frame
        return name

    def member(self, column: str, values: DataFrame) -> str:
        """Whether a plain column's value is among the rows of ``values`` (a join, not a list)."""
        name = f"__in{len(self.sets)}"
        self.sets[name] = (column, values)
        return name

    def doc_freq(self, field: str, term: str) -> tuple[str, str]:
        """(df, idf) of a term; the term becomes a feature of the statistics pass."""
        self.tf(field, term)
        name = self.term_stats.setdefault((field, term), f"t{len(self.term_stats)}")
        return f"{STATS}.df_{name}", f"{STATS}.idf_{name}"

    def avg_length(self, field: str) -> str:
        self.length(field)
        name = self.length_stats.setdefault(field, f"len{len(self.length_stats)}")
        return f"{STATS}.avg_{name}"

    def row_freq(self, match: Column, n_values: Column) -> tuple[str, str, str]:
        """(df, idf, average value count) of a test on plain columns."""
        name = f"r{len(self.row_stats)}"
        self.row_stats[name] = (match, n_values)
        return tuple(f"{STATS}.{s}_{name}" for s in ("df", "idf", "avg"))

    # -- computing -------------------------------------------------------------

    @property
    def text_used(self) -> list[str]:
        names = [f for f, _ in self.terms] + [f for f, _ in self.tests.values()]
        names += [p.field for p in self.phrases] + list(self.lengths)
        return list(dict.fromkeys(names))

    @property
    def names(self) -> list[str]:
        """The columns ``scan_frame`` adds."""
        return [*self.sets, *self.terms.values(), *self.tests, *self.phrases.values(), *self.lengths.values()]

    def attach_sets(self, df: DataFrame) -> DataFrame:
        for name, (column, values) in self.sets.items():
            listed = values.select(F.col(values.columns[0]).alias("__value")).distinct().withColumn(name, F.lit(True))
            df = df.join(listed, F.col(f"`{column}`") == F.col("__value"), "left").drop("__value")
        return df

    def attach_lookups(self, df: DataFrame) -> DataFrame:
        return df.withColumns({n: f.scalar() for n, f in self.lookups.items()}) if self.lookups else df

    def scan_frame(self, df: DataFrame) -> DataFrame:
        """``df`` with one column per feature, from one analysis of each text."""
        fields = self.text_used
        df = self.attach_sets(df)
        if not fields:
            return df
        slot = {f: f"__slots{i}" for i, f in enumerate(fields)}
        for f in fields:
            df = bind(df, slot[f], field_slots(self.corpus.spec(f)))
        df = self.attach_lookups(df)
        out = {}
        hits = dict(slot)  # with many terms, count in the few slots that hold any of them
        for f in fields:
            asked = [t for g, t in self.terms if g == f]
            if len(asked) > MANY_TERMS:
                hits[f] = f"__hits{len(slot)}_{slot[f]}"
                df = bind(df, hits[f], F.filter(slot[f], _one_of(asked)))
        for (f, term), name in self.terms.items():
            out[name] = F.size(hits[f]) - F.size(F.array_remove(hits[f], term))
        for name, (f, predicate) in self.tests.items():
            out[name] = F.coalesce(F.exists(slot[f], predicate), F.lit(False))
        for spec, name in self.phrases.items():
            out[name] = _phrase_count(F.col(slot[spec.field]), spec)
        for f, name in self.lengths.items():
            out[name] = token_count(F.col(slot[f]))
        df = bind(df, "__q", F.struct(*[c.alias(n) for n, c in out.items()]))
        return df.select("*", "__q.*").drop("__q", *slot.values(), *hits.values(), *self.lookups)

    @property
    def needs_stats(self) -> bool:
        return bool(self.term_stats or self.length_stats or self.row_stats)

    def totals(self, frame: DataFrame) -> DataFrame:
        """One row of counts over ``frame``, the features of every row (a partial aggregate)."""
        aggs = [F.count(F.lit(1)).alias("n")]
        for key, s in self.term_stats.items():
            aggs.append(F.expr(f"count_if({self.terms[key]} > 0) AS df_{s}"))
        for field, s in self.length_stats.items():
            aggs.append(F.sum(self.lengths[field]).alias(f"sum_{s}"))
        for s, (match, n_values) in self.row_stats.items():
            aggs += [F.count_if(match).alias(f"df_{s}"), F.sum(n_values).alias(f"sum_{s}")]
        return frame.agg(*aggs)

    def stats_struct(self, totals: DataFrame) -> DataFrame:
        """Raw totals to the struct the score columns read."""
        cols = ["n"]
        for s in [*self.term_stats.values(), *self.row_stats]:
            cols += [f"df_{s}", f"{idf_sql('n', f'df_{s}')} AS idf_{s}"]
        for s in [*self.length_stats.values(), *self.row_stats]:
            cols.append(f"sum_{s} / n AS avg_{s}")
        return totals.select(F.expr(f"struct({', '.join(cols)})").alias(STATS))


def _one_of(terms: list[str]) -> Callable[[Column], Column]:
    return lambda t: t.isin(*terms)


def scan_base(corpus: Corpus, features: Features) -> DataFrame:
    return spread(corpus.df, corpus.id_col) if features.text_used and corpus.id_col else corpus.df


def _phrase_count(slots: Column, spec: PhraseSpec) -> Column:
    """Start positions from which the phrase can be read within its slop."""
    n = len(spec.terms)
    exact = spec.terms[: n - 1] if spec.prefix else spec.terms
    present = F.lit(True)
    for term in dict.fromkeys(exact):
        present = present & F.array_contains(slots, term)

    if spec.slop == 0:
        def starts(word: Column, i: Column) -> Column:
            ok = spec.fits(0, word)
            for k in range(1, n):
                ok = ok & spec.fits(k, F.get(slots, i + k))
            return ok
    else:
        def starts(word: Column, i: Column) -> Column:
            # Taking the nearest next term at each step keeps the total gap smallest.
            follow = F.array(*[F.lit(t) for t in spec.terms[1:]])
            end = F.aggregate(
                follow, i,
                lambda at, t: (at + F.nullif(
                    F.array_position(F.slice(slots, at + 2, F.lit(spec.slop + 1)), t), F.lit(0).cast("bigint")
                )).cast("int"),
            )
            return (word == spec.terms[0]) & (end - i - (n - 1) <= spec.slop)

    return F.when(present, F.size(F.filter(slots, starts))).otherwise(0)


def phrase_count_from_positions(columns: list[Column], slop: int) -> Column:
    """The same count from each term's sorted position array."""
    first, rest = columns[0], columns[1:]
    n = len(columns)
    if slop == 0:
        shared = first
        for k, col in enumerate(rest, start=1):
            shared = F.array_intersect(shared, _shifted(col, k))
        count = F.size(shared)
    else:
        def fits(i: Column) -> Column:
            end = F.aggregate(
                F.array(*rest), i, lambda at, ps: F.array_min(F.filter(ps, lambda p: p > at))
            )
            return end - i - (n - 1) <= slop

        count = F.size(F.filter(first, fits))
    present = columns[0].isNotNull()
    for col in rest:
        present = present & col.isNotNull()
    return F.when(present, count).otherwise(0)


def _shifted(positions: Column, k: int) -> Column:
    return F.transform(positions, lambda p: p - k)
