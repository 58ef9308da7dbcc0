"""Positions within a group, and exact samples, without one task for a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import digest
from ..sources.staging import staged

#: Rows that one window orders.
TOGETHER = 200_000


def with_position(df: DataFrame, by: list[str], order: str, out: str = "i", then: tuple[str, ...] = (), n: int | None = None) -> DataFrame:
    """Number the rows of each group from 0, by a numeric column (ties by ``then``).

    Rows are ordered within ranges of the column whose bounds are quantiles;
    a range's rows start after those of the ranges before it.  ``n``: the number
    of rows, if it is known.
    """
    n = df.select(order).count() if n is None else n
    ranges = max(1, -(-n // TOGETHER))
    if ranges == 1:
        bucket = F.lit(0)
    else:
        bounds = sorted(set(df.approxQuantile(order, [k / ranges for k in range(1, ranges)], 1e-4)))
        # A binary search in the bounds: how many are below the value.
        bucket = F.when(F.col(order).isNull(), 0).otherwise(_below(F.col(order), bounds, 0, len(bounds)))
    dealt = df.withColumn("_range", bucket)
    inside = Window.partitionBy(*by, "_range").orderBy(order, *then)
    numbered = dealt.withColumn("_k", F.row_number().over(inside) - 1)
    if ranges == 1:
        return numbered.withColumn(out, F.col("_k").cast("long")).drop("_k", "_range")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = dealt.groupBy(*by, "_range").agg(F.count("*").alias("_n")).select(*by, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    return numbered.join(ahead, [*by, "_range"]).withColumn(out, F.col("_ahead") + F.col("_k")).drop("_k", "_ahead", "_range")


def _below(value, bounds, low: int, high: int):
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value > bounds[middle], _below(value, bounds, middle + 1, high)).otherwise(_below(value, bounds, low, middle))


def with_place(df: DataFrame, text: str, out: str) -> DataFrame:
    """Number the rows from 0 by a column of text: sorted in ranges, which are written, and then numbered one by one."""
    ranged = staged(df.repartitionByRange(text).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    ahead = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    numbered = ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_range").orderBy(text)) - 1)
    return numbered.join(F.broadcast(ahead), "_range").withColumn(out, F.col("_ahead") + F.col("_k")).drop("_k", "_ahead", "_range")


def sample_rank(df: DataFrame, seed: int, purpose: str, key: str, out: str = "rk", n: int | None = None) -> DataFrame:
    """Rank the rows in a random order from 1: the first k are an exact sample of k.

    Rows are ordered within slices of the digest, and start after the slices before.
    """
    slices = max(1, -(-(df.select(key).count() if n is None else n) // TOGETHER))
    dealt = df.withColumn("_d", digest(seed, purpose, key))
    dealt = dealt.withColumn("_s", F.floor(F.conv(F.substring("_d", 1, 8), 16, 10).cast("double") * slices / float(1 << 32)).cast("int"))
    ranked = dealt.withColumn("_k", F.row_number().over(Window.partitionBy("_s").orderBy("_d", key)))
    before = Window.partitionBy(F.lit(0)).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each slice.
    ahead = dealt.groupBy("_s").agg(F.count("*").alias("_n")).select("_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    return ranked.join(ahead, "_s").withColumn(out, (F.col("_ahead") + F.col("_k")).cast("long")).drop("_d", "_s", "_k", "_ahead")
