"""Shared helpers: the shared folder, cut tables and joins with a checked size."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in a batch between the JVM and Python: long texts in Spark's 10,000 take tens of MB on both sides.
BATCH_ROWS, _BATCH = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Most bytes that a side may have before ``join_checked`` stops broadcasting it.
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, one of our own (local masters only)."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    own = getattr(spark.sparkContext, "_tessaphon_shared", None)
    if own is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = "file://" + tempfile.mkdtemp(prefix="tessaphon-")
        spark.sparkContext.setCheckpointDir(own)
        spark.sparkContext._tessaphon_shared = own
    return own


def fresh(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/tessaphon/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str, rows: int = BATCH_ROWS) -> DataFrame:
    """Write a table to the shared folder and read it again: its lineage ends here.

    A batch between the JVM and Python has at most so many rows.
    """
    spark = df.sparkSession
    path, before = fresh(spark, tag), int(spark.conf.get(_BATCH))
    # Only for this write; the caller's limit holds if it is lower, and comes back.
    spark.conf.set(_BATCH, min(before, rows) if before > 0 else rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessaphon_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables made by ``cut`` that nothing will read again."""
    for df in tables:
        path = getattr(df, "_tessaphon_path", None)
        if path:
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table_bytes(df: DataFrame) -> int:
    """Bytes on disk of a table made by ``cut``."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(df._tessaphon_path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def join_checked(left: DataFrame, right: DataFrame, on, how: str = "inner", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join with a cut table on the right: broadcast up to ``limit`` bytes on disk, shuffled beyond that."""
    return left.join(F.broadcast(right) if table_bytes(right) <= limit else right, on, how)


def frugal(run):
    """A function of mapInArrow whose worker gives its memory back to the system when its task ends.

    Workers are used again, for other operators too, and wait in between; what each of them held would add up.
    """

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    """Return what the process has freed to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shrink(spark: SparkSession) -> None:
    """Let each executor's JVM collect its garbage and give the heap that it doesn't fill back to the system.

    A heap that one step has filled with garbage stays as large in the next one, whose Python workers need room beside it.
    As many tasks as there are executors: idle ones get one each; one that is missed only keeps its heap.
    """
    executors = max(1, spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1)
    spark.range(0, executors, 1, executors).select(F.expr("reflect('java.lang.System', 'gc')").alias("gc")).write.format("noop").mode("overwrite").save()


def text_of(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
