"""Inputs and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry import Corpus, of_kind, text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str, analyzer: str = "default") -> Corpus:
    """``documents`` with its text analysed and a ``/lang/source`` facet."""
    df = table(spark, sf_dir, "documents").withColumn("path", F.concat(F.lit("/"), "lang", F.lit("/"), "source"))
    return Corpus(df, "doc_id", {"text": text(analyzer), "path": of_kind("facet")}, unique_ids=True)


def of_table(name: str, id_col: str | None = None, **fields):
    def load(spark: SparkSession, sf_dir: str) -> Corpus:
        return Corpus(table(spark, sf_dir, name), id_col, fields)

    return load


# Tokens of `documents`: 0-based word position and folded form; long words leave a hole.
TOK = r"""
word AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM documents)
),
tok AS (SELECT doc_id, pos, lower(w) AS term FROM word WHERE octet_length(encode(w)) < 40)"""


def bm25_sql(tf: str, df: str) -> str:
    return f"(ln(1+(n-{df}+0.5)/({df}+0.5))*2.2*{tf}/({tf}+1.2*(0.25+0.75*dl/avgdl)))"


def scored_sql(terms: list[str]) -> str:
    """CTEs ending in ``sc``: per document tf ``f0..``, BM25 ``s0..`` and, with tf 1, ``b0..``."""
    freq = ", ".join(f"count(*) FILTER (WHERE term = '{t}') AS f{i}" for i, t in enumerate(terms))
    seen = ", ".join(f"count(*) FILTER (WHERE f{i} > 0) AS d{i}" for i in range(len(terms)))
    scores = ", ".join(
        f"CASE WHEN f{i} > 0 THEN {bm25_sql(f'f{i}', f'd{i}')} ELSE 0 END AS s{i}, "
        f"CASE WHEN f{i} > 0 THEN {bm25_sql('1', f'd{i}')} ELSE 0 END AS b{i}"
        for i in range(len(terms))
    )
    return f"""WITH {TOK},
feat AS (SELECT doc_id, count(*) AS dl, {freq} FROM tok GROUP BY doc_id),
st AS (
  SELECT (SELECT count(*) FROM documents) AS n,
         sum(dl) / (SELECT count(*) FROM documents) AS avgdl, {seen}
  FROM feat
),
sc AS (SELECT feat.*, n, avgdl, {scores} FROM feat, st)"""
