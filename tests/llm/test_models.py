"""Quality classifier, mixing and the pipeline: held-out accuracy, brute force, whole runs."""

import os
import random

import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from textquarry.llm import decontamination, mixing, quality
from textquarry.llm.common import stored

from .rows import empty, frame
from .test_duplicates import brute_lines, brute_similar
from .test_text_scans import brute_hits

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
HELD_OUT = os.environ.get("TEST_HELD_OUT_DIR", "/root/testdata/sf0.1")
LABELS = "doc_id long, quality int, toxic int, text string"


def prose(pick, n):
    return " ".join(pick.choice(["alpha", "beta", "gamma", "delta"]) + str(pick.randrange(300)) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    """Documents of known kinds; labels for half of them."""
    pick, rows, labels = random.Random(8), [], []
    for k in range(240):
        kind = k % 8
        text = prose(pick, 60)
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            text = " | ".join(text.split())
        elif kind == 2:
            text = " ".join(w for w in text.split()[:8] for _ in range(8))
        elif kind == 3:
            w = text.split()
            for bad in ("zogg", "zogging", "flurb"):
                w.insert(pick.randrange(len(w)), bad)
            text = " ".join(w)
        rows.append((k, text))
        if k % 16 < 8:
            labels.append((k, int(kind > 2), int(kind == 3), "x"))
    return rows, labels


def test_classifier(spark, corpus):
    rows, labels = corpus
    extra = [(500, None), (501, ""), (None, rows[5][1]), (5, rows[5][1])]
    table = spark.createDataFrame(labels + [(None, 1, 1, "x"), (7, None, None, "x"), (4, 1, 0, "x")], LABELS)
    got = quality.score_documents(frame(spark, rows + extra), table).collect()
    assert len(got) == len(rows) + len(extra)
    kept = {r.doc_id: r.kept for r in got}
    right = [kept[k] == (k % 8 > 3) for k, _ in rows]
    assert np.mean(right) > 0.97 and all(kept[k] for k, _ in rows if k % 8 > 3)
    assert kept[500] and kept[501]
    assert len({(r.p_junk, r.p_toxic) for r in got if r.doc_id in (5, None)}) == 1


def test_classifier_on_unseen_labels(spark):
    """Fitted on half of the labels, read on the other half."""
    docs = spark.read.parquet(f"{HELD_OUT}/documents.parquet")
    labels = stored(spark.read.parquet(f"{HELD_OUT}/labels.parquet").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))))
    scored = quality.score_documents(docs, labels.where("half = 0"))
    kind = F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").otherwise("clean")
    read = scored.join(labels.where("half = 1").select("doc_id", "quality", "toxic"), "doc_id").groupBy(kind.alias("kind")).agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.kind: r.kept for r in read.collect()}
    print(kept)
    assert kept["junk"] <= 0.05 and kept["toxic"] <= 0.1 and kept["clean"] >= 0.99


def test_classifier_without_rows(spark, corpus):
    table = spark.createDataFrame([], LABELS)
    assert quality.score_documents(empty(spark), table).count() == 0
    assert all(r.kept for r in quality.score_documents(frame(spark, corpus[0][:20]), table).collect())


def test_expectation_maximisation():
    """Accuracies of labellers that vote at random given the class are found without labels."""
    draw = np.random.default_rng(3)
    truth = draw.random(20_000) < 0.2
    votes = np.where(truth[:, None], np.where(draw.random((20_000, 5)) < 0.8, 1, -1), np.where(draw.random((20_000, 5)) < 0.001, 1, -1))
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = quality.expectation_maximisation(patterns, counts.astype(float))[place.ravel()]
    assert np.mean((posterior > 0.5) == truth) > 0.99
    assert abs(posterior.mean() - truth.mean()) < 0.01


def test_mixing_meets_targets(spark):
    pick = random.Random(4)
    vocabulary = {"en": ["the", "of", "and"], "de": ["der", "und", "das"], "fr": ["le", "et", "les"]}
    rows = []
    for k in range(200):
        lang = pick.choice(["en"] * 6 + ["de", "fr"])
        rows.append((k, " ".join(pick.choice(vocabulary[lang] + ["x", "y"]) for _ in range(pick.randrange(1, 60))), lang))
    rows += [(300, None, None), (301, "", "de"), (302, "zzz unknown", "en"), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame([(i, t, lang, 1, 2) for i, t, lang in rows], "doc_id long, text string, lang string, rate int, th int")
    labels = spark.createDataFrame([(k,) for k in range(0, 200, 2)] + [(None,)], "doc_id long")
    targets = {"en": 0.5, "de": 0.3, "fr": 0.2, "nowhere": 0.4}
    out = mixing.mix_documents(docs, labels, targets).collect()
    assert len(out) == len(rows) and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in out)
    words = sum(r.n_words for r in out)
    for lang in vocabulary:
        held = sum(r.n_words * r.rate * next(p.p for p in r.posterior if p.domain == lang) for r in out)
        assert abs(held - targets[lang] * words) < 0.01 * words
    by_lang = [r.domain == r.lang for r in out if r.lang and r.n_words > 8]
    assert np.mean(by_lang) > 0.98

    domains, members = mixing.memberships(docs, labels)
    table = [(m.n_words, m.copies, list(m.posterior)) for m in members.collect()]
    n, p = np.array([a * b for a, b, _ in table], float), np.array([q for _, _, q in table])
    rate, goal = np.ones(len(n)), np.array([targets[d] for d in domains]) * n.sum()
    start = n @ p
    steps, gap = mixing.fit_rates(members, domains, targets)
    assert steps and gap <= mixing.TOLERANCE
    for step in steps:
        move = ((n * rate) @ p - goal) / start
        assert np.allclose(move, step, atol=1e-9)
        rate = np.maximum(0, rate - p @ move)


def test_mixing_of_many_domains(spark):
    """Every labelled domain is modelled and meets its target, however many there are."""
    pick = random.Random(14)
    names = [f"d{k:02}" for k in range(40)]
    own = {d: [f"{d}w{n}" for n in range(30)] for d in names}
    rows = [(k, " ".join(pick.choice(own[names[k % 40]] + ["x", "y", "z"]) for _ in range(pick.randrange(20, 80))), names[k % 40], 7) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, target_gap int")
    labels = spark.createDataFrame([(k,) for k in range(400)], "doc_id long")
    targets = {d: 1.0 + n % 3 for n, d in enumerate(names)}
    out = mixing.mix_documents(docs, labels, targets).collect()
    assert len(out) == 800 and all(r.domain == r.lang for r in out) and {r.target_gap <= mixing.TOLERANCE for r in out} == {True}
    words = sum(r.n_words for r in out)
    for d in names:
        held = sum(r.n_words * r.rate * next(p.p for p in r.posterior if p.domain == d) for r in out)
        assert abs(held - targets[d] / sum(targets.values()) * words) < 0.001 * words


def test_mixing_says_when_targets_cannot_be_met(spark):
    """All texts are alike, so no rates can tell the domains apart."""
    docs = spark.createDataFrame([(k, "same words here", "ab"[k % 2], 0) for k in range(40)], "doc_id long, text string, lang string, rate int")
    labels = spark.createDataFrame([(k,) for k in range(40)], "doc_id long")
    out = mixing.mix_documents(docs, labels, {"a": 0.9, "b": 0.1}).collect()
    assert len(out) == 40 and all(abs(r.target_gap - 0.8) < 0.01 for r in out)


def test_samples_are_bounded_by_rows(spark):
    """One id on very many rows is one row of the sample; very long texts are whole."""
    rows = [(1, f"zogg text {k}") for k in range(300)] + [(2, "b " * 200_000), (3, None)]
    docs, labels = frame(spark, rows), spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(len(r.w) for r in mixing.labelled_sample(docs, labels).collect()) == [0, 3, 200_000]
    assert mixing.mix_documents(docs, labels).count() == 302 and quality.score_documents(docs, labels).count() == 302


def test_mixing_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long")
    docs = frame(spark, [(1, "a b"), (None, None)])
    assert sorted((r.doc_id or 0, r.rate, r.copies) for r in mixing.mix_documents(docs, labels).collect()) == [(0, 1.0, 1), (1, 1.0, 1)]
    assert mixing.mix_documents(empty(spark), labels).count() == 0


def test_stages_against_brute_force(spark):
    """Each stage on what the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    columns = docs.columns
    docs = stored(docs.unionByName(docs.limit(3)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long"))))
    scored = {(r.doc_id, r.text): r.kept for r in quality.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    kept = stored(corpus_pipeline.quality_stage(spark, docs, SF))
    assert kept.columns == columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((r.doc_id, r.text) for r in docs.collect() if scored[(r.doc_id, r.text)]), key=repr)

    before = [(r.doc_id, r.text) for r in kept.collect()]
    cut = stored(corpus_pipeline.line_stage(spark, kept, SF))
    want = brute_lines(before, 10**9, 1, 0.5)
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr) == sorted(((i, want[(i, t)][0]) for i, t in before if not want[(i, t)][1] or want[(i, t)][0].strip(" ")), key=repr)

    before = [(r.doc_id, r.text) for r in cut.collect()]
    single = stored(corpus_pipeline.near_duplicate_stage(spark, cut, SF))
    groups = {}
    for (i, t), label in zip(before, brute_similar(before)):
        groups.setdefault(label, []).append((i, t))
    kept, least = [(r.doc_id, r.text) for r in single.collect()], {k: min((i for i, _ in g), key=lambda i: -1 if i is None else i) for k, g in groups.items()}
    assert len(kept) == len(groups) and all(sum((least[k], t) in kept for t in {t for i, t in g if i == least[k]}) == 1 for k, g in groups.items())

    before = [(r.doc_id, r.text) for r in single.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stored(corpus_pipeline.decontamination_stage(spark, single, SF))
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((h[0] for h in brute_hits(before, items, 10) if not h[-1]), key=repr)

    mixed = corpus_pipeline.mixing_stage(spark, clean, SF)
    assert set(columns) < set(mixed.columns) and mixed.count() == clean.count()


def test_pipeline_on_no_rows(spark):
    docs = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
    assert docs.count() == 0
    assert decontamination.contamination(docs.select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0


def test_near_duplicate_stage_keeps_one_row_of_each_component(spark):
    """Components stay apart when their least ids are equal: null ids and repeated ids with different texts."""
    pick = random.Random(5)
    texts = [prose(pick, 40) for _ in range(8)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3]), (1, texts[0]), (2, texts[4]), (3, texts[4]), (4, texts[5]), (None, texts[6]), (9, texts[7])]
    got = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (2, texts[4]), (4, texts[5]), (None, texts[6]), (9, texts[7])], key=repr)


def test_near_copies_are_not_torn_by_the_line_stage(spark):
    """Of documents that share most lines one stays, whole; shared passages still leave a document that is its own."""
    pick = random.Random(12)
    line = lambda: prose(pick, 12)
    rows, passage = [], [line(), line()]
    for k in range(0, 60, 3):
        base = [line() for _ in range(20)]
        near = list(base)
        near[pick.randrange(20)] = line()
        rows += [(k, "\n".join(base)), (k + 1, "\n".join(near)), (k + 2, "\n".join([line() for _ in range(6)] + passage))]
    cut = stored(corpus_pipeline.line_stage(spark, frame(spark, rows), SF))
    assert {r.doc_id: r.text for r in cut.where("doc_id % 3 < 2").collect()} == {i: t for i, t in rows if i % 3 < 2}
    left = {r.doc_id: r.text for r in corpus_pipeline.near_duplicate_stage(spark, cut, SF).collect()}
    assert sorted(left) == [i for i, _ in rows if i % 3 != 1]
    assert all(left[i] == t for i, t in rows if i % 3 == 0)
    assert all(left[i] == "\n".join(t.split("\n")[:6]) for i, t in rows if i % 3 == 2 and i > 2)
