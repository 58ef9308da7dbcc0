"""Tables written once and read again, so that sounds are decoded once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder_of(spark: SparkSession, tag: str) -> str:
    """A folder that nothing uses yet, below that in spark.checkpoint.dir; a local master without one gets one of its own."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None) or getattr(context, "_tessaphon_staging", None)
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = context._tessaphon_staging = "file://" + tempfile.mkdtemp(prefix="tessaphon-")
    return f"{root.rstrip('/')}/tessaphon-staged/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to a folder of its own and read it again."""
    path = folder_of(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
