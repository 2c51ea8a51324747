"""Token counts of whole texts under a BPE vocabulary, by rank-synchronous merging of ragged arrays.

A text is cut at blanks, which no token crosses. Each distinct piece of a batch is normalised and cut into pre-tokens as the
tokenizer file says; the pre-tokens lie end to end in one array of symbols. In every round each pre-token merges all places
of its own lowest-rank pair at once, until none has a pair left; the symbols that survive are its tokens. This equals
merging one place at a time because a symbol's own merge always ranks before the merges that use it (checked on loading).
Pre-tokens of over ``LONG`` symbols keep their places by rank instead, so each round touches only the places it merges.

Every text is counted in its own task without a shuffle; the vocabulary (one tokenizer file) is all that is broadcast.

Defined cases: a null text is empty; an empty one has no tokens; control strings of the vocabulary inside a text are one
token each; every row gives a row, repeated ones too; a null id stays null; other columns fall away.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.int64(1 << 40)
LONG = 512
#: Characters of text looked at together, and pieces whose counts a task remembers (one map of that size per task).
STRETCH = 1 << 20
REMEMBERED = 400_000


class Merges:
    """The pairs of a vocabulary by rank, and the first symbols of a pre-token."""

    def __init__(self, vocabulary: dict[str, int], pairs: list[tuple[str, str]], end: str):
        self.first, self.last = {}, {}
        for symbol, number in vocabulary.items():
            if len(symbol) == 1:
                self.first[symbol] = number
            if end and len(symbol) == 1 + len(end) and symbol.endswith(end):
                self.last[symbol[0]] = number
        if not end:
            self.last = self.first
        left, right, new = (np.array([vocabulary[s] for s in side], np.int64) for side in zip(*((a, b, a + b) for a, b in pairs)))
        rank = np.arange(len(left))
        made = np.full(max(vocabulary.values()) + 1, -1)
        made[new] = rank
        if len(np.unique(new)) < len(new) or (made[left] >= rank).any() or (made[right] >= rank).any():
            raise ValueError("a symbol is made by a merge that ranks after one using it")
        self.size = np.int64(len(made))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.new = keys[order], rank[order].astype(np.int64), new

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where the vocabulary has no such pair."""
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def symbols(self, token: str) -> list[int]:
        held = [self.first[c] for c in token]
        held[-1] = self.last[token[-1]]
        return held

    def count(self, tokens: list[str]) -> np.ndarray:
        """How many symbols of each (not empty) pre-token are left when nothing merges any more."""
        out = np.zeros(len(tokens), np.int64)
        short = [k for k, t in enumerate(tokens) if len(t) <= LONG]
        for k in (k for k, t in enumerate(tokens) if len(t) > LONG):
            out[k] = self._count_long(np.array(self.symbols(tokens[k]), np.int64))
        if short:
            lengths = np.array([len(tokens[k]) for k in short])
            flat = np.fromiter((s for k in short for s in self.symbols(tokens[k])), np.int64, int(lengths.sum()))
            out[short] = self._rounds(flat, lengths)
        return out

    def _rounds(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        left = np.zeros(len(lengths), np.int64)
        names, owner = np.arange(len(lengths)), np.repeat(np.arange(len(lengths)), lengths)
        while len(names):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            ranks = np.full(len(symbols), NONE)
            ranks[:-1] = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), NONE)
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(starts, append=len(symbols))
            over = lowest == NONE
            left[names[over]] = sizes[over]
            going = np.repeat(~over, sizes)
            symbols, ranks, target = symbols[going], ranks[going], np.repeat(lowest, sizes)[going]
            names, sizes = names[~over], sizes[~over]
            owner = np.repeat(np.arange(len(names)), sizes)
            at = np.flatnonzero(ranks == target)
            at = at[_alternate(np.diff(at, prepend=-2) == 1)]
            symbols[at] = self.new[target[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, owner = symbols[kept], owner[kept]
        return left

    def _count_long(self, symbols: np.ndarray) -> int:
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ranks = np.full(n, NONE)
        ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
        waiting: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[ranks[places] < NONE]
            places = places[np.argsort(ranks[places], kind="stable")]
            for held in np.split(places, np.flatnonzero(np.diff(ranks[places])) + 1):
                if len(held):
                    rank = int(ranks[held[0]])
                    if rank not in waiting:
                        heapq.heappush(order, rank)
                    waiting.setdefault(rank, []).append(held)

        wait(np.arange(n))
        gone = 0
        while order:
            rank = heapq.heappop(order)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[ranks[at] == rank]
            at = at[_alternate(np.append(False, after[at[:-1]] == at[1:]))] if len(at) else at
            if not len(at):
                continue
            eaten = after[at]
            gone += len(at)
            symbols[at], ranks[eaten] = self.new[rank], NONE
            after[at] = after[eaten]
            held = at[after[at] < n]
            before[after[held]] = held
            touched = np.unique(np.concatenate((at, before[at][before[at] >= 0])))
            ends = after[touched] >= n
            ranks[touched[ends]] = NONE
            touched = touched[~ends]
            ranks[touched] = self.rank(symbols[touched], symbols[after[touched]])
            wait(touched)
        return n - gone


def _alternate(joined: np.ndarray) -> np.ndarray:
    """Of each stretch of places that overlap their left neighbour, the first, third and so on."""
    at = np.arange(len(joined))
    return (at - np.maximum.accumulate(np.where(joined, 0, at))) % 2 == 0


class Counter:
    """Counts the tokens of texts under a tokenizer file (its JSON); remembers the pieces it has seen."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.seen = Tokenizer.from_str(definition), {"": 0}
        held = json.loads(definition)
        model = held["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges") or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in held["added_tokens"]):
            raise ValueError("the tokenizer file asks for more than pair merges and plain control strings")
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None or self._pre_tokens("a b") != ["a", "b"]:
            raise ValueError("the tokenizer file keeps blanks")
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs, model.get("end_of_word_suffix") or "")
        controls = sorted((t["content"] for t in held["added_tokens"]), key=len, reverse=True)
        self.controls = re.compile("|".join(map(re.escape, controls))) if controls else None

    def _pre_tokens(self, text: str) -> list[str]:
        return [token for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]

    def _learn(self, pieces: Iterable[str]) -> dict[str, int]:
        """Counts of pieces not seen before: their control strings and what is left of their pre-tokens."""
        pieces, owners, tokens = list(pieces), [], []
        fixed = np.zeros(len(pieces), np.int64)
        for k, piece in enumerate(pieces):
            parts = [piece]
            if self.controls and self.controls.search(piece):
                parts = self.controls.split(piece)
                fixed[k] = len(parts) - 1
            for part in filter(None, parts):
                held = self._pre_tokens(part)
                owners += [k] * len(held)
                tokens += held
        distinct = list(dict.fromkeys(tokens))
        counts = dict(zip(distinct, self.merges.count(distinct).tolist()))
        np.add.at(fixed, owners, [counts[t] for t in tokens])
        return dict(zip(pieces, fixed.tolist()))

    def _stretch(self, held: list[tuple[int, str]], totals: list[int]) -> None:
        split = [(k, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")) for k, text in held]
        if len(self.seen) > REMEMBERED:
            self.seen = {"": 0}
        self.seen |= self._learn({p for _, pieces in split for p in pieces}.difference(self.seen))
        for k, pieces in split:
            totals[k] += sum(map(self.seen.__getitem__, pieces))

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; a long text is taken stretch by stretch, cut at blanks."""
        totals, held, size = [0] * len(texts), [], 0
        for k, text in enumerate(texts):
            lo, text = 0, text or ""
            while lo < len(text):
                hi = text.find(" ", lo + STRETCH) if lo + STRETCH < len(text) else -1
                hi = len(text) if hi < 0 else hi
                held.append((k, text[lo:hi]))
                size, lo = size + hi - lo, hi + 1
                if size >= STRETCH:
                    self._stretch(held, totals)
                    held, size = [], 0
        self._stretch(held, totals)
        return totals


def count_tokens(docs: DataFrame, definition: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; ``definition`` is the tokenizer file's content."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def count(batches):
        counter = Counter(shared.value)
        for batch in batches:
            n_tokens = counter.count(batch.column("text").to_pylist())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(n_tokens, pa.int64())})

    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str, name: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        definition = file.read()
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), definition)
