"""Phone segments: alignment, extraction, time scaling, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import interpolate


def usable(intervals: DataFrame, min_duration_sec: float = 0.001) -> DataFrame:
    return intervals.filter(F.col("t1") - F.col("t0") > F.lit(float(min_duration_sec)))


def counts(intervals: DataFrame, min_duration_sec: float = 0.001, per_sample: bool = False) -> DataFrame:
    """phone, n over all samples (or for each): no sound is decoded for it."""
    by = ["sample_id", "phone"] if per_sample else ["phone"]
    return usable(intervals, min_duration_sec).groupBy(*by).agg(F.count("*").alias("n"))


def segments(intervals: DataFrame, recordings: DataFrame, min_duration_sec: float = 0.001, constant_timeframe: bool = False) -> DataFrame:
    """Samples of each interval, from recordings (sample_id, sr, y) that are decoded once."""
    found = usable(intervals, min_duration_sec).join(recordings.select("sample_id", "sr", "y"), "sample_id")
    first = F.greatest(F.round(F.col("t0") * F.col("sr")).cast("int"), F.lit(0))
    size = F.round((F.col("t1") - F.col("t0")) * F.col("sr")).cast("int")
    found = found.withColumn("y", F.slice("y", first + 1, size).cast("array<double>"))
    if constant_timeframe:
        from ..kernels.udfs import constant_timeframe as fixed

        found = found.withColumn("y", fixed()(F.col("y")))
    return found.select("sample_id", "ord", "phone", "t0", "t1", "sr", "y")


def to_length(series: DataFrame, length: int) -> DataFrame:
    """len, data: each series interpolated to a length; data must have len values."""
    checked = F.when(F.size("data") == F.col("len"), F.col("data")).otherwise(F.raise_error(F.lit("key differs from the length of the data")).cast("array<double>"))
    return series.withColumn("data", checked).withColumn("data", interpolate(F.col("data"), length))


def to_extreme_length(series: DataFrame, shortest: bool) -> DataFrame:
    """All series at the length of the shortest or the longest."""
    target = series.agg((F.min if shortest else F.max)("len")).first()[0]
    if target is None:
        raise ValueError("no series")
    return to_length(series, int(target))


def already_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of todo whose key isn't in done."""
    return todo.join(done.select(key).distinct(), key, "left_anti")
