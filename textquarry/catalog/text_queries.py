"""Registered queries over analysed text, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

import textquarry as q
from textquarry.catalog.shared import TOK, bm25_sql, docs, scored_sql, table
from textquarry.functions.analysis import tokenize
from textquarry.operators.explain import explain_scores
from textquarry.operators.search import ByField, Relevance, count, matches, search
from textquarry.operators.similar import more_like_this, search_many
from textquarry.operators.snippets import Snippet, add_snippets
from textquarry.operators.topk import top_hits
from textquarry.plans.terms import bind, term_rows
from textquarry.sources.corpus import spread
from textquarry.sources.impacts import BlockIndex
from textquarry.sources.patterns import PatternIndex, fuzzy_table
from textquarry.sources.postings import TermIndex
from textquarry.sources.scratch import scratch_path

QUERIES, ORACLE = {}, {}


def register(name, run, sql=None):
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql


def _ranked(query, limit=10, **options):
    def run(spark, sf):
        hits = search(docs(spark, sf), query, limit=limit, payload="materialized", return_fields=["doc_id"], **options)
        return hits.select("rank", "doc_id", F.round("score", 6).alias("score"))

    return run


def _scored(query):
    def run(spark, sf):
        return matches(docs(spark, sf), query, scored=True, columns=["doc_id"]).select("doc_id", F.round("score", 6).alias("score"))

    return run


def _ids(query):
    return lambda spark, sf: matches(docs(spark, sf), query, columns=["doc_id"])


def _top_sql(terms, where, score, limit=10, offset=0, order="s DESC, doc_id"):
    return (
        f"{scored_sql(terms)} SELECT rank, doc_id, round(s, 6) AS score FROM (SELECT doc_id, {score} AS s, "
        f"row_number() OVER (ORDER BY {order.replace('s DESC', f'{score} DESC').replace('s ASC', f'{score} ASC')}) AS rank "
        f"FROM sc WHERE {where}) WHERE rank > {offset} AND rank <= {offset + limit}"
    )


def _all_sql(terms, where, score):
    return f"{scored_sql(terms)} SELECT doc_id, round({score}, 6) AS score FROM sc WHERE {where}"


# -- full text and boolean ---------------------------------------------------

register("bm25_topk", _ranked(q.Match("estion ndat")), _top_sql(["estion", "ndat"], "f0 + f1 > 0", "s0 + s1"))
register("bm25_all_matches", _scored(q.Match("The OF in")),
         _all_sql(["the", "of", "in"], "f0 + f1 + f2 > 0", "s0 + s1 + s2"))
register("bm25_page", _ranked(q.Match("the of"), limit=20, offset=30),
         _top_sql(["the", "of"], "f0 + f1 > 0", "(s0 + s1)", 20, 30))
register("bm25_ascending", _ranked(q.Match("the of"), sort=[Relevance(descending=False)]),
         _top_sql(["the", "of"], "f0 + f1 > 0", "(s0 + s1)", order="s ASC, doc_id"))
register("bm25_min_score", _ranked(q.Match("estion ndat"), limit=1000, min_score=3.0),
         _top_sql(["estion", "ndat"], "f0 + f1 > 0 AND s0 + s1 >= 3.0", "(s0 + s1)", 1000))
register("bm25_and", _scored(q.Match("of the", operator="and")), _all_sql(["of", "the"], "f0 > 0 AND f1 > 0", "s0 + s1"))
register(
    "bool_must_should_not",
    _scored(q.Bool(must=[q.Match("the")], should=[q.Match("of"), q.Match("in")], must_not=[q.Match("en")])),
    _all_sql(["the", "of", "in", "en"], "f0 > 0 AND f3 = 0", "s0 + s1 + s2"),
)
register(
    "min_should_match",
    _scored(q.Bool(should=[q.Match(w) for w in ("estion", "ndat", "esat", "the")], min_should_match=2)),
    _all_sql(["estion", "ndat", "esat", "the"],
             "(f0 > 0)::INT + (f1 > 0)::INT + (f2 > 0)::INT + (f3 > 0)::INT >= 2", "s0 + s1 + s2 + s3"),
)
register(
    "bool_filter_scores",
    _scored(q.Bool(must=[q.Match("of")], filter=[q.Match("the")])),
    _all_sql(["of", "the"], "f0 > 0 AND f1 > 0", "s0 + s1"),
)
register(
    "bool_filter_unscored",
    _scored(q.Bool(must=[q.Match("of")], filter=[q.Match("the")], filter_scores=False)),
    _all_sql(["of", "the"], "f0 > 0 AND f1 > 0", "s0"),
)
register(
    "bool_text_and_columns",
    _scored(q.Bool(must=[q.Match("the")], filter=[q.Range("n_chars", gte=500, lt=5000)], must_not=[q.Term("lang", "de")])),
    f"{scored_sql(['the'])} SELECT doc_id, round(s0 + 1, 6) AS score FROM sc JOIN documents USING (doc_id) "
    "WHERE f0 > 0 AND n_chars >= 500 AND n_chars < 5000 AND lang <> 'de'",
)
register(
    "must_not_only",
    lambda spark, sf: count(docs(spark, sf), q.Bool(should=[q.Bool(must_not=[q.Match("the")]), q.Match("ndat")])),
    f"WITH {TOK} SELECT count(DISTINCT doc_id) AS total FROM tok WHERE term = 'ndat'",
)
register("boost", _scored(q.Boost(q.Match("estion"), 2.5)), _all_sql(["estion"], "f0 > 0", "2.5 * s0"))
register(
    "dismax",
    _scored(q.DisjunctionMax([q.Match("of"), q.Match("the"), q.Match("in")], tie_breaker=0.3)),
    _all_sql(["of", "the", "in"], "f0 + f1 + f2 > 0",
             "greatest(s0, s1, s2) + 0.3 * (s0 + s1 + s2 - greatest(s0, s1, s2))"),
)
register("const_score", _scored(q.ConstScore(q.Match("ndat"), 7.5)), _all_sql(["ndat"], "f0 > 0", "7.5"))
register("term_on_text", _scored(q.Term("text", "the")), _all_sql(["the"], "f0 > 0", "b0"))
register(
    "count_total",
    lambda spark, sf: count(docs(spark, sf), q.Match("estion the")),
    f"WITH {TOK} SELECT count(DISTINCT doc_id) AS total FROM tok WHERE term IN ('estion', 'the')",
)
register(
    "sort_field_with_score",
    _ranked(q.Match("estion"), limit=25, sort=[ByField("n_chars", descending=True), Relevance()]),
    f"{scored_sql(['estion'])} SELECT rank, doc_id, round(s0, 6) AS score FROM (SELECT doc_id, s0, row_number() OVER "
    "(ORDER BY n_chars DESC, s0 DESC, doc_id) AS rank FROM sc JOIN documents USING (doc_id) WHERE f0 > 0) WHERE rank <= 25",
)

# -- tests on single tokens --------------------------------------------------


def _token_sql(test):
    return f"WITH {TOK} SELECT DISTINCT doc_id FROM tok WHERE {test}"


register("token_starts_with", _ids(q.StartsWith("text", "estio")), _token_sql("starts_with(term, 'estio')"))
register("token_ends_with", _ids(q.EndsWith("text", "ndat")), _token_sql("ends_with(term, 'ndat')"))
register("token_contains", _ids(q.Contains("text", "stio")), _token_sql("contains(term, 'stio')"))
register("token_regex", _ids(q.Regex("text", "e[rs]t?ion[a-d]*")), _token_sql("regexp_full_match(term, 'e[rs]t?ion[a-d]*')"))
register("token_range", _ids(q.Range("text", gte="estion", lt="estj")), _token_sql("term >= 'estion' AND term < 'estj'"))
register("token_in", _ids(q.In("text", ["ndat", "esat", "quibble"])), _token_sql("term IN ('ndat', 'esat', 'quibble')"))
# The SQL distances count bytes, so characters outside ASCII become one-byte stand-ins.
_ASCII = r"regexp_replace(term, '[^\x00-\x7F]', '~', 'g')"
register("fuzzy", _ids(q.Fuzzy("text", "estion", 1)), _token_sql(f"levenshtein({_ASCII}, 'estion') <= 1"))
register("fuzzy_two", _ids(q.Fuzzy("text", "thousand", 2)), _token_sql(f"levenshtein({_ASCII}, 'thousand') <= 2"))
register("fuzzy_three", _ids(q.Fuzzy("text", "thousaxyz", 3)), _token_sql(f"levenshtein({_ASCII}, 'thousaxyz') <= 3"))
register("fuzzy_transpositions", _ids(q.Fuzzy("text", "etsion", 1, transpositions=True)),
         _token_sql(f"damerau_levenshtein({_ASCII}, 'etsion') <= 1"))
register(
    "fuzzy_prefix", _ids(q.Fuzzy("text", "ndatx", 1, prefix=True)),
    _token_sql(" OR ".join(f"levenshtein(left({_ASCII}, {n}), 'ndatx') <= 1" for n in (4, 5, 6))),
)

# -- phrases -----------------------------------------------------------------


def _phrase_sql(terms, condition, dfs):
    """``pf``: phrase frequency per document; score from the summed idf of ``dfs``."""
    joins = " ".join(
        f"JOIN tok t{k} ON t{k}.doc_id = t0.doc_id AND {cond}" for k, cond in enumerate(condition, start=1)
    )
    idf = " + ".join(f"ln(1+(n-d{i}+0.5)/(d{i}+0.5))" for i in dfs)
    return (
        f"{scored_sql(terms)}, pf AS (SELECT t0.doc_id, count(DISTINCT t0.pos) AS tf FROM tok t0 {joins} "
        f"WHERE t0.term = '{terms[0]}' GROUP BY t0.doc_id), wide AS (SELECT feat.doc_id, dl, st.* FROM feat, st) "
        f"SELECT doc_id, round(({idf})*2.2*tf/(tf+1.2*(0.25+0.75*dl/avgdl)), 6) AS score FROM pf JOIN wide USING (doc_id)"
    )


register("phrase", _scored(q.Phrase("text", ["of", "the"])),
         _phrase_sql(["of", "the"], ["t1.term = 'the' AND t1.pos = t0.pos + 1"], [0, 1]))
register("phrase_slop", _scored(q.Phrase("text", ["of", "the"], slop=2)),
         _phrase_sql(["of", "the"], ["t1.term = 'the' AND t1.pos - t0.pos BETWEEN 1 AND 3"], [0, 1]))
register(
    "phrase_three_slop", _scored(q.Phrase("text", ["the", "of", "in"], slop=8)),
    _phrase_sql(["the", "of", "in"], ["t1.term = 'of' AND t1.pos > t0.pos",
                                      "t2.term = 'in' AND t2.pos > t1.pos AND t2.pos - t0.pos <= 10"], [0, 1, 2]),
)
register(
    "phrase_prefix", _scored(q.PhrasePrefix("text", ["of", "th"], max_expansions=20)),
    _phrase_sql(["of"], ["t1.pos = t0.pos + 1 AND t1.term IN (SELECT DISTINCT term FROM tok WHERE starts_with(term, 'th') "
                         "ORDER BY term LIMIT 20)"], [0]),
)
register("phrase_prefix_all", _scored(q.PhrasePrefix("text", ["of", "th"])),
         _phrase_sql(["of"], ["t1.pos = t0.pos + 1 AND starts_with(t1.term, 'th')"], [0]))
register("match_phrase", _scored(q.Match("Of, the", phrase=True)),
         _phrase_sql(["of", "the"], ["t1.term = 'the' AND t1.pos = t0.pos + 1"], [0, 1]))

# -- more like this, batches, explain ----------------------------------------

_LIKE = dict(min_doc_frequency=2, max_doc_frequency=60, min_term_frequency=1, max_query_terms=25, min_word_length=4)


def _like_sql(sources, k):
    return f"""WITH {TOK},
len AS (SELECT doc_id, count(*) AS dl FROM tok GROUP BY doc_id),
st AS (SELECT (SELECT count(*) FROM documents) AS n, sum(dl) / (SELECT count(*) FROM documents) AS avgdl FROM len),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
freq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
cand AS (
  SELECT doc_id AS query_id, term, df, tf * ln(1+(n-df+0.5)/(df+0.5)) AS w
  FROM tf JOIN freq USING (term), st
  WHERE df BETWEEN 2 AND 60 AND length(term) >= 4 AND {sources}
),
best AS (
  SELECT query_id, term, df, w / max(w) OVER (PARTITION BY query_id) AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(w, 9) DESC, term) AS pos FROM cand)
  WHERE pos <= 25
),
pairs AS (
  SELECT query_id, tf.doc_id, sum(w * {bm25_sql('1', 'df')}) AS s
  FROM best JOIN tf USING (term) JOIN len ON len.doc_id = tf.doc_id, st
  WHERE tf.doc_id <> query_id GROUP BY query_id, tf.doc_id
)
SELECT query_id, rank, round(s, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM pairs) WHERE rank <= {k}"""


def _like_one(spark, sf):
    hits = search(docs(spark, sf), q.MoreLikeThis(69, **_LIKE), limit=20, payload="materialized", return_fields=["doc_id"])
    return hits.select(F.lit(69).cast("long").alias("query_id"), F.col("rank"), F.round("score", 6).alias("score"))


def _like_all(spark, sf, corpus=docs):
    hits = more_like_this(corpus(spark, sf), k=5, like=q.MoreLikeThis(None, **_LIKE))
    return hits.select("query_id", "rank", F.round("score", 6).alias("score"))


register("more_like_this", _like_one, _like_sql("doc_id = 69", 20))
register("more_like_this_batch", _like_all, _like_sql("true", 5))

_BATCH_SQL = r"""
qword AS (SELECT item_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}]+')) AS w FROM benchmark),
qtf AS (SELECT item_id, lower(w) AS term, count(*) AS qtf FROM qword WHERE octet_length(encode(w)) < 40 GROUP BY ALL),"""


def _many(spark, sf, corpus=docs):
    hits = search_many(corpus(spark, sf), table(spark, sf, "benchmark"), k=10, query_id="item_id")
    return hits.select(F.col("query_id").alias("item_id"), "rank", F.round("score", 6).alias("score"))


register(
    "search_many", _many,
    f"""WITH {TOK},{_BATCH_SQL}
len AS (SELECT doc_id, count(*) AS dl FROM tok GROUP BY doc_id),
st AS (SELECT (SELECT count(*) FROM documents) AS n, sum(dl) / (SELECT count(*) FROM documents) AS avgdl FROM len),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
freq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
pairs AS (
  SELECT item_id, doc_id, sum(qtf * {bm25_sql('tf', 'df')}) AS s
  FROM qtf JOIN tf USING (term) JOIN freq USING (term) JOIN len USING (doc_id), st GROUP BY item_id, doc_id
)
SELECT item_id, rank, round(s, 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS rank FROM pairs) WHERE rank <= 10""",
)


def _explain(spark, sf):
    corpus = docs(spark, sf)
    query = q.Bool(must=[q.Match("the")], should=[q.Boost(q.Term("text", "of"), 2.0)])
    rows = explain_scores(corpus, query)
    return rows.where("matched AND term IS NOT NULL AND node <> 'Match'").select(
        "doc_id", "term", "tf", "df", "length", F.round("idf", 6).alias("idf"),
        F.round("contribution", 6).alias("contribution"),
    )


register(
    "explain_scores", _explain,
    f"{scored_sql(['the', 'of'])} "
    "SELECT doc_id, 'the' AS term, f0 AS tf, d0 AS df, dl AS length, round(ln(1+(sc.n-d0+0.5)/(d0+0.5)), 6) AS idf, "
    "round(s0, 6) AS contribution FROM sc, st WHERE f0 > 0 UNION ALL "
    "SELECT doc_id, 'of', 1, d1, dl, round(ln(1+(sc.n-d1+0.5)/(d1+0.5)), 6), round(b1, 6) FROM sc, st WHERE f1 > 0",
)


def _snippet(spark, sf):
    """Properties every fragment must have, for all matching documents."""
    corpus, query = docs(spark, sf), q.Match("estion ndat")
    rows = matches(corpus, query)
    hits = add_snippets(rows, corpus, query, [Snippet("text", pre_tag="\x03", post_tag="\x04", name="frag")])
    plain = F.translate("frag", "\x03\x04", "")
    for raw, esc in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"), ("&", "&amp;")):
        plain = F.replace(plain, F.lit(esc), F.lit(raw))
    tagged = F.regexp_extract_all("frag", F.lit("\x03([^\x04]*)\x04"), F.lit(1))
    return hits.select(
        "doc_id",
        (F.size(tagged) > 0).alias("has_tag"),
        F.forall(tagged, lambda t: F.lower(t).isin("estion", "ndat")).alias("tags_are_terms"),
        (F.length(plain) <= 150).alias("fits"),
        F.col("text").contains(plain).alias("is_part_of_text"),
    )


register(
    "snippet_page",
    lambda spark, sf: search(docs(spark, sf), q.Match("estion ndat"), limit=10, payload="materialized", return_fields=["doc_id"],
                             snippets=[Snippet("text", name="frag")])
    .select("rank", "doc_id", F.col("frag").contains("<b>").alias("tagged")),
    _top_sql(["estion", "ndat"], "f0 + f1 > 0", "(s0 + s1)").replace("round(s, 6) AS score", "true AS tagged"),
)
register(
    "snippet", _snippet,
    f"WITH {TOK} SELECT DISTINCT doc_id, true AS has_tag, true AS tags_are_terms, true AS fits, true AS is_part_of_text "
    "FROM tok WHERE term IN ('estion', 'ndat')",
)

# -- term index ----------------------------------------------------------------


def _indexed(query):
    """The same query answered from a stored index instead of the text."""
    def run(spark, sf):
        corpus = docs(spark, sf)
        index = TermIndex.build(corpus, scratch_path(spark, "index"))
        return matches(corpus.with_index(index), query, scored=True, columns=["doc_id"]).select("doc_id", F.round("score", 6).alias("score"))

    return run


register(
    "indexed_bool",
    _indexed(q.Bool(must=[q.Match("the")], should=[q.Match("of"), q.Match("in")], must_not=[q.Match("en")])),
    ORACLE["bool_must_should_not"],
)
register("indexed_phrase_slop", _indexed(q.Phrase("text", ["of", "the"], slop=2)), ORACLE["phrase_slop"])


def _indexed_top(text, **page):
    def run(spark, sf):
        corpus = docs(spark, sf)
        index = TermIndex.build(corpus, scratch_path(spark, "index"))
        blocks = BlockIndex.build(index, scratch_path(spark, "blocks"), block_rows=16)
        return top_hits(corpus.with_index(index), blocks, text, **page).hits.select("rank", "doc_id", F.round("score", 6).alias("score"))

    return run


def _with_index(spark, sf):
    corpus = docs(spark, sf)
    return corpus.with_index(TermIndex.build(corpus, scratch_path(spark, "index")))


register("indexed_search_many", lambda spark, sf: _many(spark, sf, _with_index), ORACLE["search_many"])
register("indexed_like_batch", lambda spark, sf: _like_all(spark, sf, _with_index), ORACLE["more_like_this_batch"])
register("indexed_topk", _indexed_top("estion ndat"), ORACLE["bm25_topk"])
register("indexed_topk_page", _indexed_top("the of", limit=20, offset=30), ORACLE["bm25_page"])


def _indexed_pattern(query, looked_up="grams"):
    """Rows by id of a test on terms, its dictionary entries found by their grams or deletions."""
    def run(spark, sf):
        corpus = docs(spark, sf)
        index = TermIndex.build(corpus, scratch_path(spark, "index"))
        index = index.with_patterns(PatternIndex.build(index.terms, scratch_path(spark, "patterns"), tables=[looked_up]))
        return matches(corpus.with_index(index), query, columns=["doc_id"])

    return run


register("indexed_contains", _indexed_pattern(q.Contains("text", "stio")), ORACLE["token_contains"])
register("indexed_regex", _indexed_pattern(q.Regex("text", "e[rs]t?ion[a-d]*")), ORACLE["token_regex"])
register("indexed_suffix", _indexed_pattern(q.EndsWith("text", "ndat")), _token_sql("suffix(term, 'ndat')"))
register("indexed_fuzzy", _indexed_pattern(q.Fuzzy("text", "thousand", 2), "deletions"), ORACLE["fuzzy_two"])


def _fuzzy_table(spark, sf):
    """Dictionary terms near the first word of each benchmark item."""
    corpus = docs(spark, sf)
    index = TermIndex.build(corpus, scratch_path(spark, "index"))
    words = table(spark, sf, "benchmark").select(F.lower(F.regexp_extract("text", "[A-Za-z]+", 0)).alias("word")).where("word <> ''")
    patterns = PatternIndex.build(index.terms.where("term RLIKE '^[a-z]+$'"), scratch_path(spark, "patterns"), tables=["deletions"])
    return fuzzy_table(patterns, words, 2)


register(
    "fuzzy_table", _fuzzy_table,
    f"WITH {TOK}, dictionary AS (SELECT term, count(DISTINCT doc_id) AS df FROM tok WHERE regexp_full_match(term, '[a-z]+') GROUP BY term), "
    "asked AS (SELECT DISTINCT lower(regexp_extract(text, '[A-Za-z]+')) AS word FROM benchmark) "
    "SELECT word, term, levenshtein(word, term)::INT AS distance, df FROM asked JOIN dictionary ON levenshtein(word, term) <= 2 WHERE word <> ''",
)
register(
    "term_dictionary",
    lambda spark, sf: term_rows(docs(spark, sf), ["text"]).groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf")),
    f"WITH {TOK} SELECT 'text' AS field, term, count(DISTINCT doc_id) AS df, count(*) AS total_tf FROM tok GROUP BY term",
)

# -- tokenizers ----------------------------------------------------------------


def _tokens(analyzer, name="documents", key="doc_id", column="text"):
    """Per row: token count, total length, and an order-sensitive digest of the tokens."""
    def run(spark, sf):
        tokens = tokenize(F.col(column), analyzer)
        rows = spread(table(spark, sf, name).select(key, column), key)
        return bind(rows, "tokens", tokens).select(
            key, F.size("tokens").alias("n"), F.md5(F.array_join("tokens", "\n")).alias("digest")
        )

    return run


def _tokens_sql(words, fold, key="doc_id", source="documents", column="text"):
    return (
        f"SELECT {key}, len(ts)::INT AS n, md5(array_to_string(ts, chr(10))) AS digest FROM (SELECT {key}, "
        f"list_transform(list_filter({words.format(c=column)}, lambda w: octet_length(encode(w)) < 40), lambda w: {fold}) AS ts "
        f"FROM {source})"
    )


_WORDS = r"regexp_extract_all({c}, '[\p{{L}}\p{{N}}]+')"
_BLANK = r"regexp_extract_all({c}, '[^ \t\n\f\r]+')"
register("tokenize_default", _tokens("default"), _tokens_sql(_WORDS, "lower(w)"))
register("tokenize_simple", _tokens("simple"), _tokens_sql(_WORDS, "w"))
register("tokenize_whitespace", _tokens("whitespace"), _tokens_sql(_BLANK, "lower(w)"))
register("tokenize_whitespace_raw", _tokens("whitespace_raw"), _tokens_sql(_BLANK, "w"))
register("tokenize_raw", _tokens("raw", "part", "p_partkey", "p_name"),
         "SELECT p_partkey, 1 AS n, md5(p_name) AS digest FROM part")
register("tokenize_lowercase", _tokens("lowercase", "customer", "c_custkey", "c_name"),
         "SELECT c_custkey, 1 AS n, md5(lower(c_name)) AS digest FROM customer")
register(
    "tokenize_ngram", _tokens("ngram_3_10", "part", "p_partkey", "p_name"),
    "SELECT p_partkey, len(ts)::INT AS n, md5(array_to_string(ts, chr(10))) AS digest FROM (SELECT p_partkey, "
    "[lower(left(p_name, k)) FOR k IN range(3, least(10, length(p_name)) + 1)] AS ts FROM part)",
)
register("tokenize_en_stem", _tokens("en_stem"))
register("tokenize_english_stem", _tokens("english_stem"))  # no stemmer in the SQL engine; see the unit test
