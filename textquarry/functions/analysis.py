"""Named text analyzers as column expressions.

``token_slots`` keeps one array slot per token position: a token dropped by the
length filter leaves a NULL, so later tokens keep their positions and a phrase
cannot close over the hole. ``tokenize`` is the same array without the holes.

Everything but stemming is a JVM expression. Stemming runs as an Arrow UDF on
the token array (no shuffle) that stems the distinct words of a batch.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.errors import FieldError
from textquarry.functions import stemmer

# Token classes, length limit in bytes, edge n-gram sizes.
WORD_CHARS = r"\p{IsAlphabetic}\p{N}"
BLANK_CHARS = r" \t\n\f\r"
LONG_TOKEN_BYTES = 40
NGRAM_MIN, NGRAM_MAX = 3, 10

ANALYZERS = (
    "default", "raw", "simple", "whitespace", "whitespace_raw",
    "lowercase", "ngram_3_10", "english_stem", "en_stem",
)
STEMMING = ("english_stem", "en_stem")
WORD_BASED = ("default", "simple") + STEMMING
BLANK_BASED = ("whitespace", "whitespace_raw")
CASE_KEEPING = ("raw", "simple", "whitespace_raw")

# Ship the stemmer's code with the UDF, so workers need no installed package.
cloudpickle.register_pickle_by_value(stemmer)
_stem_tokens = F.arrow_udf(stemmer.stem_arrays, T.ArrayType(T.StringType()))


def check_analyzer(name: str) -> str:
    if name not in ANALYZERS:
        raise FieldError(f"unknown analyzer {name!r}; one of {', '.join(ANALYZERS)}")
    return name


def surface_slots(text: Column, analyzer: str) -> Column:
    """Tokens as they stand in the text, before case folding and stemming."""
    check_analyzer(analyzer)
    if analyzer in WORD_BASED or analyzer in BLANK_BASED:
        cls = f"[{WORD_CHARS}]+" if analyzer in WORD_BASED else f"[^{BLANK_CHARS}]+"
        words = F.regexp_extract_all(text, F.lit(cls), F.lit(0))
        return F.transform(words, lambda w: F.when(F.octet_length(w) < LONG_TOKEN_BYTES, w))
    return F.array(text)


def token_slots(text: Column, analyzer: str = "default") -> Column:
    """Analysed tokens by position, NULL where a token was dropped."""
    if check_analyzer(analyzer) == "ngram_3_10":
        sizes = F.sequence(F.lit(NGRAM_MIN), F.least(F.length(text), F.lit(NGRAM_MAX)))
        grams = F.transform(sizes, lambda n: F.lower(F.left(text, n)))
        empty = F.array().cast("array<string>")
        return F.when(F.length(text) >= NGRAM_MIN, grams).when(text.isNotNull(), empty)
    if analyzer in WORD_BASED or analyzer in BLANK_BASED:
        fold = (lambda w: w) if analyzer in CASE_KEEPING else F.lower
        cls = f"[{WORD_CHARS}]+" if analyzer in WORD_BASED else f"[^{BLANK_CHARS}]+"
        words = F.regexp_extract_all(text, F.lit(cls), F.lit(0))
        folded = F.transform(words, lambda w: F.when(F.octet_length(w) < LONG_TOKEN_BYTES, fold(w)))
        return _stem_tokens(folded) if analyzer in STEMMING else folded
    return F.array(text if analyzer in CASE_KEEPING else F.lower(text))


def tokenize(text: Column, analyzer: str = "default") -> Column:
    """Analysed tokens of a string column; NULL text gives NULL."""
    return F.when(text.isNotNull(), F.array_compact(token_slots(text, analyzer)))


def field_slots(spec) -> Column:
    """Token slots of a text field. Several values are set apart by one hole."""
    if not spec.multi:
        slots = token_slots(spec.column, spec.analyzer)
        return F.coalesce(F.when(spec.column.isNotNull(), slots), F.array().cast("array<string>"))
    if spec.analyzer in STEMMING:  # a Python UDF cannot run inside a lambda
        plain = F.transform(spec.values(), lambda v: F.array_append(token_slots(v, "default"), F.lit(None)))
        return _stem_tokens(F.flatten(plain))
    return F.flatten(
        F.transform(spec.values(), lambda v: F.array_append(token_slots(v, spec.analyzer), F.lit(None)))
    )


def analyze_literals(spark: SparkSession, wanted: list[tuple[str, str]]) -> list[list[str]]:
    """Analyse query texts with the very expressions used on columns.

    One job over a single generated row; its size is that of the request.
    """
    if not wanted:
        return []
    cols = [
        tokenize(F.lit(text), "default" if analyzer in STEMMING else analyzer).alias(f"c{i}")
        for i, (text, analyzer) in enumerate(wanted)
    ]
    row = spark.range(1).select(*cols).first()
    return [
        [stemmer.stem_word(t) for t in tokens] if analyzer in STEMMING else list(tokens)
        for tokens, (_, analyzer) in zip(row, wanted)
    ]
