"""License scans, decontamination and chat formatting against brute force and round trips."""

import hashlib
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from textquarry.llm import chat, decontamination, licenses

from .rows import awkward, empty, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_phrases(text):
    w, found = split(text), []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        found += [(k, label) for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
    places = [k for k, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def license_rows():
    parts = ["GNU General Public", "License", "the MIT license,", "CC-BY", "apache", "Élan é", "x", "Licensed under the Apache License, Version 2.0."]
    pick = random.Random(1)
    rows = [(k, " ".join(pick.choice(parts) for _ in range(pick.randrange(12)))) for k in range(60)]
    return rows + [(60, None), (61, ""), (None, "mit license"), (5, rows[5][1]), (62, "word " * 5000 + "mit license")]


def test_licenses(spark):
    rows = license_rows()
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == sorted(((i, *brute_phrases(t)) for i, t in rows), key=repr)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1 for r in got)
    assert licenses.scan_licenses(empty(spark)).count() == 0


def test_notices_bear_edits(spark):
    rows = [(1, "Redistribution and use, in source or binary forms, with or without any modification, are permitted"), (2, "redistribution of the source and binary forms")]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert got[1].labels == "bsd" and 0.6 <= got[1].score < 1 and got[1].n_base == 0
    assert got[2].labels == "" and got[2].score == 0


def brute_hits(rows, items, size):
    windows = {}
    for item, text in items:
        w = split(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        w, hit, found = split(text), set(), set()
        for win, named in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= named
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows_limit", [200_000, 0])
def test_decontamination(spark, monkeypatch, rows_limit):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows_limit)
    monkeypatch.setattr(decontamination.small, "__defaults__", (rows_limit,))
    rows, items = awkward(6, 50), [(10, "ab cd ef gh ü"), (2, "x1 x1"), (3, None), (4, "..."), (None, "ü ü ab"), (2, "cd AB ab"), (5, "gh")] + [(k, t) for k, t in awkward(7, 8)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, window string")
    monkeypatch.setattr(decontamination, "contamination", lambda d, b, f=decontamination.contamination: f(d, b, 4))
    frames = iter([frame(spark, rows), bench])

    class Reader:
        class read:
            parquet = staticmethod(lambda _: next(frames))

    got = decontamination.query(Reader, "").collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got), key=repr) == brute_hits(rows, items, 4)


def test_decontamination_matches(spark):
    docs = frame(spark, [(1, "one two three four five"), (2, "one two other three four"), (3, "four three two one")])
    items = spark.createDataFrame([(9, "two three four")], "item_id long, text string")
    assert [tuple(r) for r in decontamination.phrase_matches(docs, items).collect()] == [(1, "9", 1, 3)]
    near = {r.doc_id for r in decontamination.proximity_matches(docs, items, slop=1).collect()}
    assert near == {1, 2}
    assert decontamination.contamination(empty(spark), items).count() == 0
    assert {r.n_hit for r in decontamination.contamination(docs, items.limit(0)).collect()} == {0}


def brute_proximity(rows, items, size, slop):
    texts = [(i, split(t)) for i, t in rows]
    counts = {}
    for _, w in texts:
        for x in w:
            counts[x] = counts.get(x, 0) + 1
    found = set()
    for item, text in items:
        held = split(text)
        for k in range(max(1, len(held) - size + 1)):
            window = held[k:k + size]
            if not window or any(x not in counts for x in window):
                continue
            _, offset, rarest = min((counts[x], n, x) for n, x in enumerate(window))
            for i, w in texts:
                for start in (p - offset for p, x in enumerate(w) if x == rarest):
                    near = all(x in w[max(0, start + n - slop):max(0, start + n + slop + 1)] for n, x in enumerate(window))
                    if near and start >= -slop:
                        found.add((i, str(item), start))
    return found


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity_of_ten_words(spark, slop):
    """All ten words of a window are looked for, not only the rarest three."""
    pick = random.Random(slop)
    vocabulary = [f"v{n}" for n in range(60)]
    passages = [[pick.choice(vocabulary) for _ in range(14)] for _ in range(6)]
    rows = []
    for k in range(80):
        w = list(passages[k % 6])
        for _ in range(pick.randrange(4)):
            at = pick.randrange(len(w) - 1)
            change = pick.randrange(4)
            w[at:at + 2] = [[w[at + 1], w[at]], [w[at], "new", w[at + 1]], [w[at]], ["new", w[at + 1]]][change]
        rows.append((k, " ".join(w if k % 5 == 0 else [pick.choice(vocabulary) for _ in range(pick.randrange(9))] + w)))
    rows += [(None, " ".join(passages[0])), (200, None), (7, rows[7][1])]
    items = [(n, " ".join(p)) for n, p in enumerate(passages)] + [(50, "v1 v2"), (51, None), (52, "never v1")]
    want = brute_proximity(rows, items, 10, slop)
    got = decontamination.proximity_matches(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"), 10, slop).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and len(want) > 20


def test_decontamination_of_null_ids(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = [(None, f"so {passage} then"), (1, passage), (None, "one two three four other"), (2, "nothing of it")]
    items = [(9, passage), (8, "nothing here")]
    got = decontamination.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, len(r.item_ids)) for r in got), key=repr) == sorted((h[:4] for h in brute_hits(rows, items, 10)), key=repr)
    assert [r.n_hit for r in got if r.doc_id is None and r.n_words == 13] == [11]


TEXTS = st.text(st.sampled_from("ab~<|>[]/\n01\\éü😀\x00"), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["user", "assistant", "system"]), TEXTS), st.one_of(st.none(), TEXTS)), max_size=8))
def test_chat_round_trip(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumnRenamed("conv_id", "conv_id")
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in out.select("*", chat.read_turns(out["formatted"]).alias("read")).collect()}
    want = {}
    for conv, turn, role, text in turns:
        want.setdefault(conv, []).append((turn, (role or "").encode(), (text or "").encode()))
    assert set(got) == set(want)
    for conv, listed in want.items():
        listed = [(r.decode(), t.decode()) for _, r, t in sorted(listed)]
        assert [tuple(x) for x in got[conv].read] == listed
        assert [s.loss for s in got[conv].segments[1::3]] == [r == "assistant" for r, _ in listed]
        assert "".join(s.text for s in got[conv].segments) == got[conv].formatted


def test_chat_order(spark):
    talks = {1: ["user", "assistant"], 2: ["system", "user", "assistant", "user"], 3: ["assistant"], 4: ["user", "user"], 5: ["user", "tool"]}
    df = spark.createDataFrame([(c, k, r, "t") for c, roles in talks.items() for k, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.valid, r.complete) for r in chat.format_conversations(df).collect()}
    assert got == {1: (True, True), 2: (True, False), 3: (False, False), 4: (False, False), 5: (False, False)}
    assert chat.format_conversations(df.limit(0)).count() == 0
