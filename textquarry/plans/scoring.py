"""Okapi BM25 as column arithmetic.

The SQL-text forms build the same expressions from column names; a query of
many terms is put together much faster from a few texts than from many calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K1 = 1.2
B = 0.75


def idf_sql(n_docs: str, doc_freq: str) -> str:
    return f"log1p(({n_docs} - {doc_freq} + 0.5D) / ({doc_freq} + 0.5D))"


def bm25_sql(tf: str, length: str, idf: str, avg_length: str) -> str:
    norm = f"{K1}D * ({1 - B}D + {B}D * {length} / {avg_length})"
    return f"{idf} * {K1 + 1}D * {tf} / ({tf} + {norm})"


def idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log1p((n_docs - doc_freq + 0.5) / (doc_freq + 0.5))


def bm25(tf: Column, length: Column, idf_value: Column, avg_length: Column) -> Column:
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / avg_length)
    return idf_value * F.lit(K1 + 1) * tf / (tf + norm)
