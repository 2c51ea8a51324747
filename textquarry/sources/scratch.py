"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from textquarry.errors import RequestError


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared folder; a local one only in local mode, where none need be named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local"):
        raise RequestError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='textquarry-')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to a scratch folder and read back: what follows reads it as often as it needs, at no second analysis."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
