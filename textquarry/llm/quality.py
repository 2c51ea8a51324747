"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer.

Overlapping labellers vote reject (1), keep (-1) or abstain (0) on two questions, junk and toxic. The counts of all vote
patterns over all documents let EM estimate how each labeller votes for either class; the posterior of a document's
votes is its label. A hashed linear scorer per question (words and votes as features, logistic loss) is trained on the
posterior labels of a bounded sample of labelled rows, and scores every document. The toxic labellers look words and
word beginnings up in lists of terms that stand out in the sample's toxic rows.

Defined cases: a null text is empty; a text without words on which all labellers abstain is kept; without
any labelled row nothing is rejected; equal rows get equal scores; all columns of the documents stay (the result's own
names replace columns of that name). Nulls and repeated ids among the labels: null rows are left out, the largest label
of an id counts. Of documents that share an id, one (of the least text) enters the sample, so it never has more rows than
its bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.llm.arrays import Rolling, text_chunks, word_bounds, word_hashes
from textquarry.llm.common import stored, words

#: Bound of the sample of labelled rows that lists and scorer are fitted on, and of each list.
SAMPLE_ROWS = 20_000
LIST_TERMS = 5_000
MIN_DOCS, MIN_ODDS = 4, 30.0
BEGINNINGS = (0, 5, 4)

#: Of each junk labeller: keeps at most so much, rejects from so much on.
JUNK = {
    "punctuation": (0.12, 0.18), "capitals": (0.2, 0.35), "repeated_triples": (0.3, 0.4), "repeated_lines": (0.34, 0.4),
    "stuttered_words": (0.05, 0.2), "bars": (0.0, 0.05), "wordless_tokens": (0.1, 0.3), "doubled_marks": (0.0, 0.2),
}
TOXIC = ("words", "beginnings_5", "beginnings_4")
TOXIC_HITS = 2
MIN_LINES = 4
#: No labeller is taken to reject more than this share of good documents: it may miss what it does not look for.
FALSE_ALARM = 0.002

BITS = 18
#: Penalty on the squares of the word weights, per document: what one document alone says of a word counts little.
PENALTY = 1e-3
RESULT = ("p_junk", "p_toxic", "kept")

_byte = np.arange(256)
_ALNUM = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
_CAPITAL = (_byte >= 65) & (_byte <= 90)
_SPACE = np.isin(_byte, [0x20, *range(0x09, 0x0E)])
_MARK = (_byte < 128) & ~_ALNUM & ~_CAPITAL & ~_SPACE & (_byte > 32)
_LOWER = np.where(_CAPITAL, _byte + 32, _byte).astype(np.uint8)
_LINE = np.ones(256, bool)
_LINE[10] = False


def _repeated(owner: np.ndarray, hashes: np.ndarray, docs: int) -> np.ndarray:
    """Per document the share of its hashes that it has had before."""
    order = np.lexsort((hashes, owner))
    again = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][1:][again], minlength=docs) / np.maximum(1, np.bincount(owner, minlength=docs))


class Chunk:
    """Word hashes and statistics of the texts of a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.docs = len(offsets) - 1
        lower = _LOWER[data]
        self.starts, ends = word_bounds(lower, offsets, _ALNUM)
        self.owner = np.searchsorted(offsets, self.starts, "right") - 1
        rolling = Rolling(lower.astype(np.uint64) + np.uint64(1))
        self.words = rolling.stretch(self.starts, ends)
        self.begins = {n: rolling.stretch(self.starts, np.minimum(self.starts + n, ends))[ends - self.starts > n] for n in BEGINNINGS if n}
        self.begin_owner = {n: self.owner[ends - self.starts > n] for n in self.begins}
        self.count = np.bincount(self.owner, minlength=self.docs)
        size = np.maximum(1, np.diff(offsets))
        per = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
        marks = _MARK[data]
        doubled = np.zeros(len(data), bool)
        doubled[1:] = marks[1:] & (data[1:] == data[:-1])
        tokens = np.maximum(1, per(np.append(False, _SPACE[data][:-1]) & ~_SPACE[data]) + 1)
        triples = Rolling(self.words).every(3)
        whole = self.owner[:len(triples)] == self.owner[2:][:len(triples)] if len(triples) else np.zeros(0, bool)
        again = (self.words[1:] == self.words[:-1]) & (self.owner[1:] == self.owner[:-1])
        lines, line_ends = word_bounds(data, offsets, _LINE)
        line_owner = np.searchsorted(offsets, lines, "right") - 1
        many = np.bincount(line_owner, minlength=self.docs) >= MIN_LINES
        self.measured = {
            "punctuation": per(marks) / size, "capitals": per(_CAPITAL[data]) / size,
            "repeated_triples": _repeated(self.owner[:len(triples)][whole], triples[whole], self.docs),
            "repeated_lines": np.where(many, _repeated(line_owner, word_hashes(data, lines, line_ends), self.docs), np.nan),
            "stuttered_words": np.bincount(self.owner[1:][again], minlength=self.docs) / np.maximum(1, self.count),
            "bars": per(data == 124) / tokens, "wordless_tokens": np.maximum(0, tokens - self.count) / tokens * (self.count > 0), "doubled_marks": per(doubled) / tokens,
        }

    def votes(self, lists: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((self.docs, len(JUNK) + len(TOXIC)), np.int8)
        empty = self.count == 0
        for k, (name, (keep, reject)) in enumerate(JUNK.items()):
            x = self.measured[name]
            out[x >= reject, k] = 1
            out[(x <= keep) & ~empty, k] = -1
        for k, (n, listed) in enumerate(zip(BEGINNINGS, lists), len(JUNK)):
            terms, owner = (self.begins[n], self.begin_owner[n]) if n else (self.words, self.owner)
            hits = np.bincount(owner[np.isin(terms, listed)], minlength=self.docs)
            out[hits >= TOXIC_HITS, k] = 1
            out[(hits == 0) & ~empty, k] = -1
        return out

    def features(self, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, feature and value: distinct words and 5-byte beginnings, then votes in cells of their own."""
        owner = np.concatenate((self.owner, self.begin_owner[5]))
        cell = np.concatenate((self.words, self.begins[5])) & np.uint64((1 << BITS) - 1)
        key = np.unique((owner.astype(np.uint64) << np.uint64(BITS)) | cell)
        owner, cell = (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)
        value = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=self.docs)))[owner]
        voted = (1 << BITS) + np.arange(votes.shape[1]) * 3 + votes + 1
        docs = np.arange(self.docs)
        return (np.concatenate((owner, np.repeat(docs, votes.shape[1]))), np.concatenate((cell, voted.ravel().astype(np.int64))),
                np.concatenate((value, np.ones(voted.size))))


WEIGHTS = (1 << BITS) + 3 * (len(JUNK) + len(TOXIC)) + 1


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior of class 1 for each pattern of votes; votes are independent given the class, classes start by majority."""
    seen = np.stack([patterns == v for v in (-1, 0, 1)], -1).astype(float)
    posterior = np.where((patterns == 1).any(1), 0.9, 0.02)
    for _ in range(rounds):
        old = posterior
        weight = np.stack((counts * (1 - posterior), counts * posterior))
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        chance = np.einsum("cp,plv->clv", weight, seen) + np.array([[[2.0, 1.0, 0.1]], [[0.1, 1.0, 2.0]]])
        chance /= chance.sum(-1, keepdims=True)
        false = np.minimum(chance[0, :, 2], FALSE_ALARM)
        chance[0] *= ((1 - false) / (1 - chance[0, :, 2]))[:, None]
        chance[0, :, 2] = false
        score = np.log(prior)[:, None] + np.einsum("plv,clv->cp", seen, np.log(chance))
        posterior = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(posterior - old).max() < 1e-9:
            break
    return posterior


def term_lists(sample: DataFrame) -> list[np.ndarray]:
    """Hashes of the words and word beginnings (bytes) that stand out in toxic rows, at most ``LIST_TERMS`` a list."""
    toxic, rest = sample.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    lists = []
    for n in BEGINNINGS:
        term = F.transform(words(F.col("text")), lambda w: F.encode(w, "UTF-8"))
        if n:
            term = F.transform(F.filter(term, lambda w: F.octet_length(w) > n), lambda w: F.substring(w, 1, n))
        counts = sample.select("toxic", F.explode(F.array_distinct(term)).alias("term")).groupBy("term").agg(F.count_if(F.col("toxic") > 0).alias("a"), F.count_if(F.col("toxic") <= 0).alias("b"))
        odds = ((F.col("a") + 0.5) / max(1, toxic)) / ((F.col("b") + 0.5) / max(1, rest))
        held = counts.where((F.col("a") >= MIN_DOCS) & (odds >= MIN_ODDS)).orderBy(odds.desc(), "term").limit(LIST_TERMS).select("term").collect()
        data = np.frombuffer(b"".join(bytes(r[0]) for r in held), np.uint8)
        ends = np.cumsum([len(r[0]) for r in held], dtype=np.int64)
        lists.append(np.sort(word_hashes(data, np.append(0, ends)[:-1].astype(np.int64), ends)))
    return lists


def _train(table_rows: list[tuple], rounds: int = 12, batch: int = 256, steps: int = 400) -> np.ndarray:
    """Weights by AdaGrad on the logistic loss against posterior labels, at least ``steps`` steps. Rows: (cells, values, label)."""
    rounds = max(rounds, -(-steps * batch // len(table_rows)) if len(table_rows) >= batch else steps)
    weights, power = np.zeros(WEIGHTS), np.full(WEIGHTS, 1e-6)
    weights[-1] = -2.0
    order, penalty = np.random.default_rng(7), np.where(np.arange(WEIGHTS) < 1 << BITS, PENALTY, 0.0)
    for _ in range(rounds):
        for rows in np.array_split(order.permutation(len(table_rows)), max(1, len(table_rows) // batch)):
            cells = np.concatenate([table_rows[r][0] for r in rows])
            values = np.concatenate([table_rows[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(table_rows[r][0]) for r in rows])
            label = np.array([table_rows[r][2] for r in rows])
            p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, weights[cells] * values, minlength=len(rows)) + weights[-1], -30, 30)))
            error = p - label
            slope = np.bincount(cells, error[owner] * values, minlength=WEIGHTS) + len(rows) * penalty * weights
            slope[-1] = error.sum()
            power += slope * slope
            weights -= 0.3 * slope / np.sqrt(power)
    return weights


def _scan(batch, lists):
    """First row, end row, chunk and votes of each chunk of a batch with a ``text`` column."""
    for lo, hi, data, offsets in text_chunks(batch, "text"):
        chunk = Chunk(data, offsets)
        yield lo, hi, chunk, chunk.votes(lists)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """The term lists and the scorers' weights (junk, toxic)."""
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text)
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = stored(plain.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    lists = term_lists(sample)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(lists)

    def vote(batches):
        for batch in batches:
            for *_, votes in _scan(batch, shared.value):
                yield pa.record_batch({"votes": pa.array((votes + 1).tolist(), pa.list_(pa.int8()))})

    seen = plain.select("text").mapInArrow(vote, "votes array<tinyint>").groupBy("votes").agg(F.count("*").alias("n")).collect()
    weights = np.zeros((2, WEIGHTS))
    weights[:, -1] = -30.0
    if not seen:
        return lists, weights
    patterns, counts = np.array([r[0] for r in seen]) - 1, np.array([r[1] for r in seen], float)
    parts = (slice(0, len(JUNK)), slice(len(JUNK), None))
    posterior = [expectation_maximisation(patterns[:, p], counts) for p in parts]
    label_of = context.broadcast({tuple(x): (a, b) for x, a, b in zip(patterns.tolist(), *posterior)})

    def features(batches):
        for batch in batches:
            for lo, hi, chunk, votes in _scan(batch, shared.value):
                owner, cell, value = chunk.features(votes)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(chunk.docs + 1))
                chosen = [order[a:b] for a, b in zip(cuts, cuts[1:])]
                marks = [label_of.value[tuple(v)] for v in votes.tolist()]
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo), "cells": pa.array([cell[c].astype(np.int32).tobytes() for c in chosen]),
                    "values": pa.array([value[c].astype(np.float32).tobytes() for c in chosen]), "junk": pa.array([m[0] for m in marks]), "toxic": pa.array([m[1] for m in marks]),
                })

    def train(batches):
        table = pa.Table.from_batches(list(batches))
        if table.num_rows:
            cells = [np.frombuffer(x, np.int32) for x in table.column("cells").to_pylist()]
            values = [np.frombuffer(x, np.float32) for x in table.column("values").to_pylist()]
            for name in ("junk", "toxic"):
                weights = _train(list(zip(cells, values, table.column(name).to_pylist())))
                yield pa.record_batch({"name": pa.array([name]), "weights": pa.array([weights.tobytes()])})

    marked = sample.mapInArrow(features, "doc_id long, cells binary, values binary, junk double, toxic double")
    for name, held in marked.repartition(1).sortWithinPartitions("doc_id", "cells").mapInArrow(train, "name string, weights binary").collect():
        weights[("junk", "toxic").index(name)] = np.frombuffer(held)
    shared.destroy()
    label_of.destroy()
    return lists, weights


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with p_junk, p_toxic and kept (both below one half)."""
    docs = docs.drop(*RESULT)
    names = docs.columns
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample_rows))
    schema = T.StructType(docs.schema.fields + [T.StructField("p_junk", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def score(batches):
        lists, weights = model.value
        for batch in batches:
            texts = pa.record_batch({"text": batch.column("text").cast(pa.string()).fill_null("")})
            chances = [np.zeros((2, 0))]
            for _, _, chunk, votes in _scan(texts, lists):
                owner, cell, value = chunk.features(votes)
                sums = np.array([np.bincount(owner, w[cell] * value, minlength=chunk.docs) + w[-1] for w in weights])
                sums[:, (chunk.count == 0) & ~votes.any(1)] = -30.0
                chances.append(1 / (1 + np.exp(-np.clip(sums, -30, 30))))
            junk, toxic = np.round(np.concatenate(chances, 1), 6)
            yield pa.record_batch({n: batch.column(n) for n in names} | {"p_junk": pa.array(junk), "p_toxic": pa.array(toxic), "kept": pa.array((junk < 0.5) & (toxic < 0.5))})

    return docs.mapInArrow(score, schema)


def query(spark, sf_dir: str) -> DataFrame:
    scored = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", *RESULT)
