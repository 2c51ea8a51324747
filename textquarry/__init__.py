"""Full-text search and search-style analytics over Spark DataFrames."""

from textquarry.errors import FieldError, LiteralError, QuarryError, RequestError
from textquarry.functions.analysis import ANALYZERS, tokenize
from textquarry.plans.query import (
    All, Bool, Boost, ConstScore, Contains, DisjunctionMax, DrillDown, EndsWith, Exact, Exists, Fuzzy, In,
    Match, MoreLikeThis, Nothing, Phrase, PhrasePrefix, Query, Range, Regex, StartsWith, Term,
)
from textquarry.sources.corpus import Corpus
from textquarry.sources.fields import from_millis, of_kind, text
