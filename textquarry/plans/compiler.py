"""Query tree to columns: does a row match, and with which score."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce, singledispatchmethod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.errors import LiteralError, RequestError
from textquarry.functions.analysis import analyze_literals
from textquarry.functions.values import facet_path, ip_canonical, under_facet
from textquarry.plans import query as Q
from textquarry.plans.edits import within_edits
from textquarry.plans.features import Features, PhraseSpec
from textquarry.plans.scoring import bm25_sql
from textquarry.sources import fields as K
from textquarry.sources.corpus import Corpus
from textquarry.sources.patterns import DISTANCE, END, START, Needed, needed_by_distance, needed_by_literals, required_stretches


@dataclass(frozen=True)
class _Word(Q.Query):
    """One analysed word of a full-text query, scored with its real frequency."""

    field: str
    term: str


@dataclass
class Part:
    """A compiled node. ``needs_text`` says that a match implies some indexed term."""

    match: Column
    score: Column
    needs_text: bool = False
    details: list[dict] = field(default_factory=list)
    facts: dict = field(default_factory=dict)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _known(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


class Compiler:
    """Compiles one request; all its queries share one feature set."""

    def __init__(self, corpus: Corpus):
        self.corpus = corpus
        self.features = Features(corpus)
        self.row_fields: set[str] = set()  # columns read from the rows themselves

    def compile(self, query: Q.Query, path: str = "0") -> Part:
        part = self._node(query, path)
        part.details.insert(0, self._detail(path, query, part))
        return part

    @staticmethod
    def _detail(path: str, query: Q.Query, part: Part) -> dict:
        own = dict(path=path, node=type(query).__name__.lstrip("_"), match=part.match, score=part.score)
        return own | part.facts

    @singledispatchmethod
    def _node(self, query, path: str) -> Part:
        raise RequestError(f"not a query: {query!r}")

    # -- helpers ---------------------------------------------------------------

    def _spec(self, name: str) -> K.FieldSpec:
        spec = self.corpus.spec(name)
        if spec.kind != K.TEXT:
            self.row_fields.add(name)
        return spec

    def _string_field(self, name: str, what: str) -> K.FieldSpec:
        spec = self._spec(name)
        if spec.kind not in (K.TEXT, K.STRING):
            raise RequestError(f"{what} needs a text or string field, {name!r} is {spec.kind}")
        return spec

    def _term_test(self, spec: K.FieldSpec, predicate, needed: Needed | None = None) -> Part:
        """Rows having a term that passes a test; constant score. ``needed`` is what such a term must have."""
        if spec.kind == K.TEXT:
            return Part(self.features.test(spec.name, predicate, needed), F.lit(1.0), needs_text=True)
        return Part(spec.any_value(predicate), F.lit(1.0))

    def _scored(self, part: Part, tf: str, df: str | None, idf: str, length: str, avg: str, **names) -> Part:
        part.score = F.expr(bm25_sql(tf, length, idf, avg))
        part.facts = dict(tf=tf, df=df, idf=idf, length=length, **names)
        return part

    def _text_term(self, name: str, term: str, frequency: bool) -> Part:
        tf = self.features.tf(name, term)
        df, idf = self.features.doc_freq(name, term)
        part = Part(F.expr(f"{tf} > 0"), F.lit(0.0), needs_text=True)
        return self._scored(part, tf if frequency else f"least({tf}, 1)", df, idf, self.features.length(name),
                            self.features.avg_length(name), field=name, term=term)

    def _value_term(self, spec: K.FieldSpec, match: Column, term: str) -> Part:
        quoted = f"`{spec.name}`"
        present = f"coalesce(size(array_compact({quoted})), 0)" if spec.multi else f"int({quoted} IS NOT NULL)"
        df, idf, avg = self.features.row_freq(match, F.expr(present))
        return self._scored(Part(match, F.lit(0.0)), "1", df, idf, present, avg, field=spec.name, term=term)

    # -- leaves ----------------------------------------------------------------

    @_node.register
    def _(self, q: Q.All, path: str) -> Part:
        return Part(F.lit(True), F.lit(1.0))

    @_node.register
    def _(self, q: Q.Nothing, path: str) -> Part:
        return Part(F.lit(False), F.lit(0.0), needs_text=True)

    @_node.register
    def _(self, q: Q.Term, path: str) -> Part:
        spec = self._spec(q.field)
        if spec.kind == K.JSON:
            raise RequestError(f"term query on json field {q.field!r}; compare json_value(...) instead")
        value = K.literal(spec, q.value)
        if spec.kind == K.TEXT:
            return self._text_term(q.field, q.value, frequency=False)
        if spec.kind == K.FACET:
            return self._value_term(spec, spec.any_value(lambda v: under_facet(v, q.value)), q.value)
        if spec.kind == K.IP:
            return self._value_term(spec, spec.any_value(lambda v: ip_canonical(v) == value), q.value)
        return self._value_term(spec, spec.any_value(lambda v: v == value), str(q.value))

    @_node.register
    def _(self, q: Q.Exact, path: str) -> Part:
        self._string_field(q.field, "exact")
        return self._node(Q.Term(q.field, q.value), path)

    @_node.register
    def _(self, q: _Word, path: str) -> Part:
        if self._spec(q.field).kind == K.TEXT:
            return self._text_term(q.field, q.term, frequency=True)
        return self._node(Q.Term(q.field, q.term), path)

    @_node.register
    def _(self, q: Q.Range, path: str) -> Part:
        spec = self._spec(q.field)
        if spec.kind not in K.RANGE_KINDS:
            raise RequestError(f"range is not supported on {spec.kind} field {q.field!r}")
        low, high = (q.gt if q.gt is not None else q.gte), (q.lt if q.lt is not None else q.lte)
        if low is None and high is None:
            raise RequestError("range needs at least one bound; use Exists for any value")
        lo = None if low is None else K.literal(spec, low)
        hi = None if high is None else K.literal(spec, high)

        def inside(v: Column) -> Column:
            tests = []
            if lo is not None:
                tests.append(v > lo if q.gt is not None else v >= lo)
            if hi is not None:
                tests.append(v < hi if q.lt is not None else v <= hi)
            return _all(tests)

        return self._term_test(spec, inside)

    @_node.register
    def _(self, q: Q.In, path: str) -> Part:
        spec = self._spec(q.field)
        if spec.kind == K.JSON:
            raise RequestError(f"set query on json field {q.field!r}")
        if isinstance(q.values, DataFrame):
            if spec.multi or spec.kind not in K.TABLE_SET_KINDS:
                raise RequestError(f"a table of values needs a single-valued plain field, not {q.field!r}")
            if q.values.schema[0].dataType != spec.data_type:
                raise LiteralError(f"values of {q.field!r} must be {spec.data_type.simpleString()}")
            return Part(F.col(self.features.member(q.field, q.values)), F.lit(1.0))
        values = [K.literal(spec, v) for v in q.values]
        if not values:
            return Part(F.lit(False), F.lit(0.0), needs_text=True)
        if spec.kind == K.FACET:
            return Part(spec.any_value(lambda v: _any([under_facet(v, p) for p in q.values])), F.lit(1.0))
        shown = ip_canonical if spec.kind == K.IP else (lambda v: v)
        return self._term_test(spec, lambda v: shown(v).isin(*values))

    @_node.register
    def _(self, q: Q.StartsWith, path: str) -> Part:
        return self._term_test(self._string_field(q.field, "prefix"), lambda v: v.startswith(q.value), needed_by_literals([START + q.value]))

    @_node.register
    def _(self, q: Q.EndsWith, path: str) -> Part:
        return self._term_test(self._string_field(q.field, "suffix"), lambda v: v.endswith(q.value), needed_by_literals([q.value + END]))

    @_node.register
    def _(self, q: Q.Contains, path: str) -> Part:
        return self._term_test(self._string_field(q.field, "substring"), lambda v: v.contains(q.value), needed_by_literals([q.value]))

    @_node.register
    def _(self, q: Q.Regex, path: str) -> Part:
        if _has_anchor(q.pattern):
            raise RequestError("patterns match whole terms: ^ and $ are not allowed")
        whole = rf"\A(?:{q.pattern})\z"
        return self._term_test(self._string_field(q.field, "regex"), lambda v: v.rlike(whole), needed_by_literals(required_stretches(q.pattern)))

    @_node.register
    def _(self, q: Q.Fuzzy, path: str) -> Part:
        spec = self._string_field(q.field, "fuzzy")
        if q.transpositions and q.distance > 2:
            raise RequestError("transpositions as one edit are built for distances up to 2")
        test = within_edits(q.value, q.distance, q.transpositions, q.prefix)
        plain = not q.transpositions and not q.prefix and q.distance <= DISTANCE
        return self._term_test(spec, test, needed_by_distance(q.value, q.distance) if plain else None)

    @_node.register
    def _(self, q: Q.Exists, path: str) -> Part:
        spec = self._spec(q.field)
        self.row_fields.add(q.field)
        return Part(F.size(spec.values()) > 0 if spec.multi else spec.column.isNotNull(), F.lit(1.0))

    @_node.register
    def _(self, q: Q.DrillDown, path: str) -> Part:
        spec = self._spec(q.field)
        if spec.kind != K.FACET:
            raise RequestError(f"drill-down needs a facet field, {q.field!r} is {spec.kind}")
        where = facet_path(q.path)
        match = spec.any_value(lambda v: under_facet(v, where, exact=q.only_this_level))
        return self._value_term(spec, match, where)

    @_node.register
    def _(self, q: Q.Match, path: str) -> Part:
        if q.operator not in ("or", "and"):
            raise RequestError(f"operator must be 'or' or 'and', not {q.operator!r}")
        names = list(q.fields) or self.corpus.text_fields
        if not names:
            raise RequestError("full text needs at least one text field")
        specs = [self._string_field(n, "full text") for n in names]
        analyzers = [s.analyzer if s.kind == K.TEXT else "raw" for s in specs]
        words = analyze_literals(self.corpus.spark, [(q.text, a) for a in analyzers])
        clauses: list[Q.Query] = []
        for name, tokens in zip(names, words):
            if not tokens:
                continue
            if q.phrase and len(tokens) > 1:
                clauses.append(Q.Phrase(name, tokens, q.slop))
            elif q.operator == "and":
                clauses.append(Q.Bool(must=[_Word(name, t) for t in tokens]))
            else:
                clauses += [_Word(name, t) for t in tokens]
        return self._node(Q.Bool(should=clauses) if clauses else Q.Nothing(), path)

    @_node.register
    def _(self, q: Q.Phrase, path: str) -> Part:
        spec = self._spec(q.field)
        if spec.kind != K.TEXT:
            raise RequestError(f"phrase needs a text field, {q.field!r} is {spec.kind}")
        if not q.terms:
            return self._node(Q.Nothing(), path)
        if len(q.terms) == 1:
            raise RequestError("a phrase needs at least two terms; use Term for one")
        return self._phrase(PhraseSpec(q.field, tuple(q.terms), q.slop), q.terms)

    @_node.register
    def _(self, q: Q.PhrasePrefix, path: str) -> Part:
        spec = self._spec(q.field)
        if spec.kind != K.TEXT:
            raise RequestError(f"phrase prefix needs a text field, {q.field!r} is {spec.kind}")
        if not q.terms:
            return self._node(Q.Nothing(), path)
        allowed = None
        if q.max_expansions is not None:
            from textquarry.plans.dictionary import first_terms

            allowed = self.features.lookup(first_terms(self.corpus, q.field, q.terms[-1], q.max_expansions))
        phrase = PhraseSpec(q.field, tuple(q.terms), prefix=True, expansions=allowed)
        if len(q.terms) == 1:
            return Part(self.features.test(q.field, phrase.last_fits), F.lit(1.0), needs_text=True)
        return self._phrase(phrase, q.terms[:-1])

    def _phrase(self, spec: PhraseSpec, scored_terms) -> Part:
        tf = self.features.phrase(spec)
        idfs = " + ".join(self.features.doc_freq(spec.field, t)[1] for t in scored_terms)
        part = Part(F.expr(f"{tf} > 0"), F.lit(0.0), needs_text=True)
        return self._scored(part, tf, None, f"({idfs})", self.features.length(spec.field),
                            self.features.avg_length(spec.field), field=spec.field, term=" ".join(spec.terms))

    # -- combinations ----------------------------------------------------------

    @_node.register
    def _(self, q: Q.Bool, path: str) -> Part:
        groups = {}
        for role in ("must", "should", "must_not", "filter"):
            groups[role] = [
                self.compile(c, f"{path}.{role}[{i}]") for i, c in enumerate(getattr(q, role))
            ]
        required = groups["must"] + groups["filter"]
        should, banned = groups["should"], groups["must_not"]
        details = [d for parts in groups.values() for p in parts for d in p.details]
        if not (required or should or banned):
            return self._node(Q.All(), path)

        at_least = q.min_should_match or 0
        if not required:
            at_least = max(at_least, 1)  # only exclusions, or a zero minimum, match nothing extra
        if at_least > len(should):
            none = self._node(Q.Nothing(), path)
            none.details = details
            return none
        tests = [p.match for p in required]
        if at_least == 1:
            tests.append(_any([p.match for p in should]))
        elif at_least > 1:
            hits = [_known(p.match).cast("int") for p in should]
            tests.append(reduce(lambda a, b: a + b, hits) >= at_least)
        tests += [~_known(p.match) for p in banned]

        scores = [p.score for p in groups["must"]]
        if q.filter_scores:
            scores += [p.score for p in groups["filter"]]
        scores += [F.when(p.match, p.score).otherwise(0.0) for p in should]
        needs_text = any(p.needs_text for p in required) or (
            at_least > 0 and all(p.needs_text for p in should)
        )
        total = reduce(lambda a, b: a + b, scores) if scores else F.lit(0.0)
        return Part(_all(tests), total, needs_text, details)

    @_node.register
    def _(self, q: Q.Boost, path: str) -> Part:
        inner = self.compile(q.inner, f"{path}.inner")
        return Part(inner.match, inner.score * F.lit(float(q.factor)), inner.needs_text, inner.details)

    @_node.register
    def _(self, q: Q.ConstScore, path: str) -> Part:
        inner = self.compile(q.inner, f"{path}.inner")
        return Part(inner.match, F.lit(float(q.score)), inner.needs_text, inner.details)

    @_node.register
    def _(self, q: Q.DisjunctionMax, path: str) -> Part:
        if not q.disjuncts:
            return self._node(Q.Nothing(), path)
        parts = [self.compile(c, f"{path}.disjunct[{i}]") for i, c in enumerate(q.disjuncts)]
        scores = [F.when(p.match, p.score) for p in parts]
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        total = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0.0)) for s in scores])
        return Part(
            _any([p.match for p in parts]),
            best + F.lit(float(q.tie_breaker)) * (total - best),
            all(p.needs_text for p in parts),
            [d for p in parts for d in p.details],
        )

    @_node.register
    def _(self, q: Q.MoreLikeThis, path: str) -> Part:
        from textquarry.operators.similar import telling_terms

        terms = telling_terms(self.corpus, q)
        likes: Q.Query = Q.Bool(should=[
            Q.Term(f, t) if w is None else Q.Boost(Q.Term(f, t), w) for f, t, w in terms
        ]) if terms else Q.Nothing()
        if q.exclude_source:
            spec = self._spec(self.corpus.key())
            same = self.compile(likes, f"{path}.terms")
            source = spec.any_value(lambda v: v == K.literal(spec, q.source_id))
            return Part(same.match & ~_known(source), same.score, same.needs_text, same.details)
        return self._node(likes, path)


def _has_anchor(pattern: str) -> bool:
    """An unescaped ``^`` or ``$`` outside a character class."""
    in_class = escaped = False
    for ch in pattern:
        if escaped:
            escaped = False
        elif ch == "\\":
            escaped = True
        elif in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
        elif ch in "^$":
            return True
    return False
