"""Edit-distance tests on terms, built from Spark's thresholded ``levenshtein``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _swaps(word: str) -> set[str]:
    """The word with two unequal neighbours exchanged."""
    return {
        word[:i] + word[i + 1] + word[i] + word[i + 2 :]
        for i in range(len(word) - 1)
        if word[i] != word[i + 1]
    }


def _variants(word: str, distance: int) -> dict[str, int]:
    """Rewritings using swaps, each with the edits that remain for plain Levenshtein."""
    out = {word: distance}
    if distance >= 1:
        for s in _swaps(word):
            out[s] = max(out.get(s, -1), distance - 1)
    if distance >= 2:
        for s in _swaps(word):
            for s2 in _swaps(s):
                out.setdefault(s2, distance - 2)
        for i in range(len(word)):  # neighbours only once the letter between them is gone
            for s in _swaps(word[:i] + word[i + 1 :]):
                out.setdefault(s, distance - 2)
    return out


def within_edits(value: str, distance: int, transpositions: bool, prefix: bool) -> Callable[[Column], Column]:
    """Predicate: a term (or, with ``prefix``, a beginning of it) is close to ``value``."""
    rewritten = _variants(value, distance) if transpositions else {value: distance}

    def close(term: Column) -> Column:
        same = [w for w, left in rewritten.items() if left == 0]
        tests = [term.isin(same)] if same else []
        # levenshtein gives -1 beyond its threshold
        tests += [F.levenshtein(term, F.lit(w), d) >= 0 for w, d in rewritten.items() if d > 0]
        return reduce(lambda a, b: a | b, tests)

    if not prefix:
        return close
    sizes = range(max(len(value) - distance, 0), len(value) + distance + 1)
    return lambda term: reduce(lambda a, b: a | b, [close(F.left(term, F.lit(n))) for n in sizes])
