"""Tables over the term dictionary that answer patterns and misspellings without reading all of it.

``grams`` has one row per (field, gram, term): the stretches of GRAM characters of the term set between two marks, so the
beginning and the end of a term have grams of their own. A pattern's literal stretches name grams that a fitting term must
have; the terms that have them all are then tested with the pattern itself.

``deletions`` has one row per (field, variant, term): what is left of the term's first PREFIX characters when up to
``distance`` of them are taken out. Two words within that many edits share such a variant: of the characters an alignment
leaves as they are, those that stand in both beginnings are what is left of either, and neither loses more than the edits.
So near words meet in an equi-join and are then measured, and a term has at most 29 variants however long it is.

Each task writes both tables for its own part of the dictionary, sorted, so nothing is shuffled or sampled.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.errors import RequestError

GRAM = 3
#: Private-use characters that no analyzer leaves in a term.
START, END = "\ue000", "\ue001"
#: A pattern is looked up by at most this many of its grams; the test with the pattern itself covers the others.
MOST_GRAMS = 8
DISTANCE = 2
#: Characters of a word that deletions are taken from.
PREFIX = 7
TABLES = ("grams", "deletions")


@dataclass(frozen=True)
class Needed:
    """What a fitting term must have: all of ``grams``, or one of ``variants``."""

    grams: tuple[str, ...] = ()
    variants: tuple[str, ...] = ()
    distance: int = 0


def grams_of(stretch: str) -> list[str]:
    return [stretch[i:i + GRAM] for i in range(len(stretch) - GRAM + 1)]


def needed_by_literals(stretches: list[str]) -> Needed | None:
    """Grams of the stretches that a pattern requires; None if they are too short to have any."""
    grams = list(dict.fromkeys(g for s in stretches for g in grams_of(s)))
    if not grams:
        return None
    step = -(-len(grams) // MOST_GRAMS)  # spread over the pattern: neighbours mostly stand in the same terms
    return Needed(grams=tuple(grams[::step]))


def needed_by_distance(word: str, distance: int) -> Needed:
    word = word[:PREFIX]
    return Needed(variants=tuple(sorted({
        "".join(c for i, c in enumerate(word) if i not in gone)
        for n in range(min(distance, len(word)) + 1) for gone in combinations(range(len(word)), n)
    })), distance=distance)


def required_stretches(pattern: str) -> list[str]:
    """Literal stretches that every word fitting a regular expression has, the word's ends marked.

    Only what is plain is used: alternatives, options, quotations and back references give nothing; a group or class ends a
    stretch, and a character that may be missing (``?``, ``*``, ``{``) is left out of it.
    """
    if "|" in pattern or "(?" in pattern or r"\Q" in pattern:
        return []
    out, now, depth, i = [], START, 0, 0
    while i < len(pattern):
        c, step = pattern[i], 1
        plain = None
        if c == "\\":
            following = pattern[i + 1:i + 2]
            step = 2
            if following and not following.isalnum():
                plain = following
            elif following in "xupPkN0cbB123456789AzZG" or not following:
                return []
        elif c == "[":
            end, first = i + 1, True
            while end < len(pattern) and (pattern[end] != "]" or first):
                if pattern[end] == "[" or pattern[end:end + 2] == "&&":
                    return []
                first = pattern[end] == "^" and end == i + 1
                end += 2 if pattern[end] == "\\" else 1
            step = end + 1 - i
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c not in ".?*+{}":
            plain = c
        after = pattern[i + step:i + step + 1]
        if c == "{":
            step = pattern.find("}", i) + 1 - i
            if step <= 0:
                return []
        if depth == 0 and plain is not None and after not in ("?", "*", "{"):
            now += plain
            if after == "+":
                out.append(now)
                now = plain
        else:
            out.append(now)
            now = ""
        if c in "?*+{" and depth == 0:
            now = now if c == "+" else ""
        i += step
    return [s for s in [*out, now + END] if s not in ("", END)]


def _variants(term: Column, distance: int) -> Column:
    """What is left of a term's first PREFIX characters when up to ``distance`` (0, 1 or 2) are taken out, each once."""
    start = F.left(term, F.lit(PREFIX))
    without = lambda *gone: F.concat(*[F.substring(start, lo + 1, hi - lo) for lo, hi in zip((0, *(g + 1 for g in gone)), (*gone, PREFIX)) if hi > lo])
    return F.array_distinct(F.array(*[without(*gone) for n in range(distance + 1) for gone in combinations(range(PREFIX), n)]))


class PatternIndex:
    def __init__(self, grams: DataFrame | None, deletions: DataFrame | None, distance: int = DISTANCE):
        self.grams, self.deletions, self.distance = grams, deletions, distance

    @classmethod
    def build(cls, terms: DataFrame, path: str, distance: int = DISTANCE, mode: str = "errorifexists", tables=TABLES) -> PatternIndex:
        """Write the ``tables`` (both, unless one kind of request is all that comes) of a dictionary ``field, term, df`` under ``path``."""
        if distance not in (0, 1, 2):
            raise RequestError("deletions are kept for distances up to 2")
        marked = F.concat(F.lit(START), F.col("term"), F.lit(END))
        at = F.sequence(F.lit(1), F.greatest(F.length(marked) - GRAM + 1, F.lit(1)))
        grams = F.array_distinct(F.transform(at, lambda i: F.substring(marked, i, F.lit(GRAM))))
        for name, column, values in (("grams", "gram", grams), ("deletions", "variant", _variants(F.col("term"), distance))):
            if name in tables:
                rows = terms.select("field", "term", "df", F.explode(values).alias(column))
                rows.sortWithinPartitions("field", column, "term").write.mode(mode).partitionBy("field").parquet(f"{path}/{name}")
        return cls.open(terms.sparkSession, path, distance, tables)

    @classmethod
    def open(cls, spark: SparkSession, path: str, distance: int = DISTANCE, tables=TABLES) -> PatternIndex:
        return cls(*[spark.read.parquet(f"{path}/{t}") if t in tables else None for t in TABLES], distance)

    def answers(self, need: Needed | None) -> bool:
        if need is None or need.distance > self.distance:
            return False
        return (self.deletions if need.variants else self.grams) is not None

    def candidates(self, field: str, need: Needed) -> DataFrame:
        """``term`` of every dictionary entry that may fit; the caller tests them."""
        if need.variants:
            near = self.deletions.where((F.col("field") == field) & F.col("variant").isin(list(need.variants)))
            return near.select("term").distinct()
        held = self.grams.where((F.col("field") == field) & F.col("gram").isin(list(need.grams)))
        return held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(need.grams)).select("term")


def fuzzy_table(patterns: PatternIndex, words: DataFrame, distance: int = 1, *, field: str = "text", word: str = "word") -> DataFrame:
    """``word, term, distance, df``: the dictionary terms within ``distance`` edits of each word of a table.

    Words and terms meet under what is left of both after deletions, an equi-join whose size follows the near words and not
    the product of both tables; a null word has no terms, a repeated one is looked up once.
    """
    if patterns.deletions is None:
        raise RequestError("this index was built without deletions")
    if not 0 <= distance <= patterns.distance:
        raise RequestError(f"this index answers distances up to {patterns.distance}")
    asked = words.select(F.col(word).cast("string").alias("word")).where("word IS NOT NULL").distinct()
    asked = asked.select("word", F.explode(_variants(F.col("word"), distance)).alias("variant"))
    near = patterns.deletions.where(F.col("field") == field).join(asked, "variant").select("word", "term", "df").distinct()
    # levenshtein gives -1 beyond its threshold
    apart = F.levenshtein(F.col("word"), F.col("term"), distance)
    return near.withColumn("distance", apart).where("distance >= 0").select("word", "term", "distance", "df")
