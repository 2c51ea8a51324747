"""Mixing to target weights by soft memberships, with DataFrame functions alone.

A classifier (multinomial naive Bayes over hashed words) is fitted on a bounded sample of labelled documents, whose
language names their domain, and gives every document a posterior over all domains of the sample. Projected-gradient least
squares then fits nonnegative rates per document so that the expected tokens of each domain meet its target share:
each step sums the expected domain tokens over all documents (one aggregation to one row per domain) and moves every
rate by the residuals weighted with its posterior. In the metric used the step size one is always stable. Steps end when
the targets are met, or when a step no longer brings them nearer (targets may contradict what the documents hold);
``target_gap`` says how far off they are, as a share of all tokens asked for.

Defined cases: a null text has no words, a text without known words gets the domains' prior; labelled rows without a
language are left out; without any labelled row there are no domains and every rate is one; targets of domains that
nobody was labelled with are left out and the rest scaled up; of documents that share an id one (of the least domain and
text) enters the sample; equal rows get equal rates; all columns of the documents
stay, columns named like the result's are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.common import doc_rows, stored, words

#: Bound of the sample of labelled rows, and the cells that words are hashed into.
SAMPLE_ROWS, CELLS = 20_000, 1 << 16
#: Every domain starts with so many words, spread like those of all domains together.
SMOOTHING = 1000
#: The model has at most CELLS rows of one number per domain; with more domains than this it is joined by a shuffle.
BROADCAST_DOMAINS = 64
#: Posteriors are softened as if a text had at most so many words.
EVIDENCE = 50
TOLERANCE = 1e-4
#: A step that leaves more than this part of the gap is the last one; there are never more than STEPS.
STALLED, STEPS = 0.999, 200
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
RESULT = ("n_words", "domain", "posterior", "rate", "copies", "target_gap")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """domain and words of at most ``rows`` labelled documents, chosen by a hash of their ids."""
    ids = labels.select(labels["doc_id"].cast("long").alias("id_")).dropna().distinct().orderBy(F.xxhash64("id_"), "id_").limit(rows)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    held = docs.select(docs["doc_id"].cast("long").alias("id_"), docs["lang"].cast("string").alias("domain"), text.alias("text")).where("domain IS NOT NULL")
    single = held.join(F.broadcast(stored(ids)), "id_").groupBy("id_").agg(F.min(F.struct("domain", "text")).alias("d"))
    return stored(single.select("d.domain", words(F.col("d.text")).alias("w")))


def _cell(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(CELLS)).cast("int")


def word_model(sample: DataFrame) -> tuple[list[str], list[float], DataFrame]:
    """Domains, their log priors, and (cell, log likelihood per domain) for the cells of the sample's words."""
    counted = sample.groupBy("domain").agg(F.count("*").alias("n"), F.sum(F.size("w")).alias("words")).collect()
    sizes = {r["domain"]: (r["n"], r["words"]) for r in counted}
    domains, total, tokens = sorted(sizes), sum(n for n, _ in sizes.values()), sum(w for _, w in sizes.values())
    priors = [math.log(sizes[d][0] / total) for d in domains]
    seen = sample.select("domain", F.explode("w").alias("word")).groupBy(_cell(F.col("word")).alias("cell"), "domain").agg(F.count("*").alias("n"))
    cells = seen.groupBy("cell").agg(F.map_from_entries(F.collect_list(F.struct("domain", "n"))).alias("by"), F.sum("n").alias("n"))
    if not domains:
        return domains, priors, cells.select("cell", F.array().cast("array<double>").alias("chance"))
    start = F.col("n") * (SMOOTHING / max(1, tokens))
    each = F.arrays_zip(F.array(*map(F.lit, domains)).alias("domain"), F.array(*[F.lit(float(sizes[d][1] + SMOOTHING)) for d in domains]).alias("size"))
    chance = F.transform(each, lambda d: F.log((F.coalesce(F.try_element_at("by", d["domain"]), F.lit(0)) + start) / d["size"]))
    return domains, priors, stored(cells.select("cell", chance.alias("chance")))


def memberships(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], DataFrame]:
    """The domains, and per distinct row doc_id, th, copies, n_words and posterior (array in the domains' order)."""
    domains, priors, model = word_model(labelled_sample(docs, labels, sample_rows))
    k = range(len(domains))
    listed = F.concat(words(F.col("text")), F.array(F.lit(None).cast("string")))
    tokens = doc_rows(docs).select("doc_id", "th", listed.alias("w")).select("doc_id", "th", F.posexplode("w").alias("at", "token"))
    tokens = tokens.withColumn("mine", _cell(F.col("token")))  # of the end, which has no word, it is not looked at
    joined = tokens.join(F.broadcast(model) if len(domains) <= BROADCAST_DOMAINS else model, (F.col("mine") == F.col("cell")) & F.col("token").isNotNull(), "left")
    end = F.col("token").isNull()
    summed = joined.groupBy("doc_id", "th").agg(
        F.max(F.when(end, F.col("at"))).cast("long").alias("n_words"), F.count_if(end).alias("copies"), F.count("cell").alias("known"),
        *[F.sum(F.get("chance", F.lit(i))).alias(f"s{i}") for i in k])
    known = F.col("known") / F.col("copies")
    soft = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest(known, F.lit(1.0)))
    scores = F.array(*[F.round(F.coalesce(F.col(f"s{i}") / F.col("copies"), F.lit(0.0)) * soft + priors[i], 9) for i in k]) if domains else F.array().cast("array<double>")
    shifted = F.transform("scores", lambda s: F.exp(s - F.array_max("scores")))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    out = summed.withColumn("scores", scores).withColumn("e", shifted).withColumn("posterior", F.transform("e", lambda x: x / total))
    return domains, stored(out.select("doc_id", "th", "copies", "n_words", "posterior"))


def _rate(steps: list[list[float]]) -> Column:
    """The rate after ``steps``, each a residual per domain, starting from one."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    moves = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    dot = lambda step: F.aggregate(F.zip_with(step, F.col("posterior"), lambda u, p: u * p), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(moves, rate, lambda r, step: F.greatest(F.lit(0.0), r - dot(step)))


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], budget: float | None = None) -> tuple[list[list[float]], float]:
    """The steps of projected gradient that bring the expected domain tokens to their targets (of ``budget`` tokens).

    Also how far off the targets still are, as a share of the tokens asked for.
    """
    share = [max(0.0, targets.get(d, 0.0)) for d in domains]
    if not sum(share):
        return [], 0.0

    def sums(steps):
        weight = F.col("n_words") * F.col("copies") * _rate(steps)
        return [r or 0.0 for r in members.agg(*[F.sum(weight * F.get("posterior", F.lit(i))) for i in range(len(domains))]).first()]

    held = sums([])
    goal = [s / sum(share) * (budget if budget is not None else sum(held)) for s in share]
    off = lambda now: sum(abs(a - b) for a, b in zip(now, goal)) / max(1.0, sum(goal))
    steps, now = [], held
    while off(now) > TOLERANCE and len(steps) < STEPS:
        step = [float(f"{(a - b) / h:.12g}") if h else 0.0 for a, b, h in zip(now, goal, held)]
        then = sums([*steps, step])
        if off(then) >= off(now):
            break
        steps, now, before = [*steps, step], then, now
        if off(now) > STALLED * off(before):
            break
    return steps, off(now)


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """Per distinct row of ``docs``: doc_id, th, rows (how often it stands there), n_words, domain, posterior, rate, copies.

    ``copies`` is the whole number of times to take the row: the rate rounded down or up, up as often as its fraction says.
    """
    domains, members = memberships(docs, labels)
    steps, gap = fit_rates(members, domains, targets, budget)
    rate = F.round(_rate(steps), 6)
    names = F.array(*map(F.lit, domains)) if domains else F.array().cast("array<string>")
    named = F.transform(F.arrays_zip(names.alias("domain"), F.transform("posterior", lambda p: F.round(p, 6)).alias("p")), lambda z: F.struct(z["domain"].alias("domain"), z["p"].alias("p")))
    best = F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int")) if domains else F.lit(None).cast("string")
    chance = F.pmod(F.xxhash64("doc_id", "th"), F.lit(1_000_000)) / 1_000_000
    rated = members.withColumn("rate", rate).withColumn("domain", best).withColumn("named", named)
    out = rated.select("doc_id", "th", F.col("copies").alias("rows"), "n_words", "domain", F.col("named").alias("posterior"), "rate", F.lit(round(gap, 6)).alias("target_gap"))
    return out.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """``docs`` with n_words, domain, posterior, rate, copies and target_gap."""
    docs = docs.drop(*RESULT)
    found = rates(docs, labels, targets).drop("rows").withColumnsRenamed({"doc_id": "id_", "th": "th_"})
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("id_")) & (F.xxhash64(text) == F.col("th_"))
    return docs.join(found, same).drop("id_", "th_")


def query(spark, sf_dir: str) -> DataFrame:
    found = rates(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), TARGETS)
    return found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select("doc_id", "n_words", "domain", "posterior", "rate", "copies", "target_gap")
