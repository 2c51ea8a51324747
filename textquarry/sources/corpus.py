"""A corpus: a DataFrame, the kinds of its fields, and an optional term index."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.errors import FieldError, RequestError
from textquarry.functions.analysis import check_analyzer
from textquarry.sources.fields import TEXT, FieldSpec, resolve_fields


#: Inputs above this size are never reshuffled before analysis.
SPREAD_BYTES = 256 << 20


def _inside(file: str, folder: str) -> bool:
    plain = lambda p: "/" + unquote(urlparse(p).path).strip("/") + "/"
    return plain(file).startswith(plain(folder))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Redistribute an input too small to give every core a file split.

    A small file is read by one task, which would leave the other cores idle
    while text is being analysed. The decision uses the optimizer's size
    estimate, so nothing runs; an input of some gigabytes per hundred cores, or
    of unknown size, passes through and is never shuffled for this.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(split)
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(slots, key) if estimate * 4 < min(slots * split_bytes, 4 * SPREAD_BYTES) else df


class Corpus:
    """``df`` plus what the operators need to know about it.

    ``id_col`` names the row key (needed by upsert, explain, more-like-this and
    the term index). ``seq_col`` gives the "index order"; the id by default.
    ``fields`` overrides the kind of single columns: ``{"body": text("simple"),
    "path": "facet"}``. Undeclared columns get a kind from their type.
    ``unique_ids`` promises that no id occurs twice. A ranked search may then
    decide on ids alone and fetch texts for the page only; without the promise
    the text is analysed a second time instead.
    """

    def __init__(self, df: DataFrame, id_col: str | None = None, fields: dict | None = None,
                 seq_col: str | None = None, unique_ids: bool = False):
        self.df = df
        self.fields: dict[str, FieldSpec] = resolve_fields(df.schema, fields or {})
        for name in (id_col, seq_col):
            if name is not None and name not in df.columns:
                raise FieldError(f"no column {name!r}")
        for spec in self.fields.values():
            check_analyzer(spec.analyzer)
        self.id_col, self.seq_col, self.unique_ids = id_col, seq_col or id_col, unique_ids
        self.index = None

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    @property
    def text_fields(self) -> list[str]:
        return [n for n, s in self.fields.items() if s.kind == TEXT]

    def spec(self, name: str) -> FieldSpec:
        if name not in self.fields:
            raise FieldError(f"no field {name!r}")
        return self.fields[name]

    def key(self) -> str:
        if self.id_col is None:
            raise FieldError("this operation needs a corpus with an id column")
        return self.id_col

    def id_text(self) -> Column:
        """The id as it is echoed on hits: text as is, bytes as hexadecimal."""
        spec = self.fields.get(self.key())
        if spec is not None and spec.kind == "bytes":
            return F.lower(F.hex(spec.column))
        return F.col(f"`{self.id_col}`").cast("string")

    def with_df(self, df: DataFrame) -> Corpus:
        """The same declarations over other rows; an index no longer applies."""
        out = Corpus.__new__(Corpus)
        out.df, out.fields, out.index = df, self.fields, None
        out.id_col, out.seq_col, out.unique_ids = self.id_col, self.seq_col, self.unique_ids
        return out

    def with_index(self, index) -> Corpus:
        """The same corpus answering text queries from a stored term index (ids must be unique)."""
        out = self.with_df(self.df)
        out.index = index
        return out

    # -- storage ---------------------------------------------------------------

    def tagged(self) -> DataFrame:
        """The rows with every declaration attached as column metadata."""
        return self.df.select(
            *[
                F.col(f"`{n}`").alias(n, metadata=self.fields[n].metadata()) if n in self.fields
                else F.col(f"`{n}`")
                for n in self.df.columns
            ]
        )

    def save(self, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None,
             cluster_by_id: bool = False) -> Corpus:
        """Write as Parquet and return the corpus reading it back.

        ``cluster_by_id`` sorts the files by id, so that reading a page of hits skips the others.
        """
        if mode == "overwrite" and any(_inside(f, path) for f in self.df.inputFiles()):
            raise RequestError(f"this corpus is read from {path}; overwriting it would remove what is still to be read")
        rows = self.tagged()
        if cluster_by_id:
            rows = rows.repartitionByRange(self.key()).sortWithinPartitions(self.key())
        writer = rows.write.mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return Corpus.open(self.spark, path, self.id_col, self.seq_col, self.unique_ids)

    @classmethod
    def open(cls, spark: SparkSession, path: str, id_col: str | None = None, seq_col: str | None = None,
             unique_ids: bool = False) -> Corpus:
        """Open a saved corpus. Kinds and analyzers come with the data; the id is named again.

        Other formats: read them with Spark and declare the fields, ``Corpus(spark.read.json(...), ...)``.
        """
        return cls(spark.read.parquet(path), id_col, seq_col=seq_col, unique_ids=unique_ids)

    @classmethod
    def create(cls, df: DataFrame, path: str | None = None, id_col: str | None = None,
               fields: dict | None = None, seq_col: str | None = None) -> Corpus:
        """A corpus over ``df``, kept at ``path`` if given; an existing one there is opened instead."""
        corpus = cls(df, id_col, fields, seq_col)
        if path is None:
            return corpus
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
        return cls.open(df.sparkSession, path, id_col, seq_col) if fs.exists(where) else corpus.save(path)
