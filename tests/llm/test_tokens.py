"""Token counts against the library's own encoding."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textquarry.llm import tokens

from .rows import awkward, empty, frame

WORDS = "word_bpe_49k.json"


def definition(name):
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def texts():
    pick = random.Random(5)
    odd = ["", " ", "it's they'LL we've 'S", "<|endoftext|>", "a<|startoftext|>b<|ENDOFTEXT|> <|endoftext|>x", "12345 3.14", "ΟΔΟΣ Σ İstanbul ǅ ß",
           "é ́x a b c\x85d\x1ce\x0bf", "日本語のテキスト한국어", "🙂👩‍👩‍👧 zwj", "=" * 700, "a" * 5000, "ab" * 3000, "\n\n\t x\r\ny", "ﬁ ﷺ ẛ̣", "힣ᆨ", "\x00\x01"]
    odd.append("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(30_000)))
    odd.append("".join(pick.choice("etaoin") for _ in range(3_000)))
    odd.append(" ".join("".join(pick.choice("abcdeéñüßж'’.-0<|>") for _ in range(pick.randrange(1, 25))) for _ in range(4_000)))
    return odd + [pick.choice(odd[:10]) + pick.choice([" ", "", "\n"]) + pick.choice(odd[:10]) for _ in range(200)]


def test_word_vocabulary_against_the_library():
    tokenizer = Tokenizer.from_str(definition(WORDS))
    held = texts()
    assert tokens.Counter(definition(WORDS)).count(held) == [len(e.ids) for e in tokenizer.encode_batch(held, add_special_tokens=False)]


def test_stretches_and_a_full_memory_change_nothing(monkeypatch):
    held = texts()
    want = tokens.Counter(definition(WORDS)).count(held)
    monkeypatch.setattr(tokens, "STRETCH", 50)
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    monkeypatch.setattr(tokens, "LONG", 6)
    assert tokens.Counter(definition(WORDS)).count(held) == want


def test_rows(spark):
    rows = awkward(11) + [(90, "<|endoftext|> don't " * 900), (91, "x" * 40_000)]
    tokenizer = Tokenizer.from_str(definition(WORDS))
    got = tokens.count_tokens(frame(spark, rows), definition(WORDS)).collect()
    want = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(r.over_limit for r in got)
    assert tokens.count_tokens(empty(spark), definition(WORDS)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_str(definition(WORDS))
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs]
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in tokens.query(spark, sf).collect()) == sorted(want)


def test_a_vocabulary_out_of_order_is_refused():
    with pytest.raises(ValueError):
        tokens.Merges({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")], "")


def test_a_vocabulary_that_keeps_blanks_is_refused():
    with pytest.raises(ValueError):
        tokens.Counter(definition("byte_bpe_50k.json"))
