"""Chunks of recordings, and their pitch copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import chunk_count, cut_chunks
from ..functions.hashing import draw


def chunk(recordings: DataFrame, seconds: float, keep_tail: bool = False) -> DataFrame:
    """file_name, sr, y to one row for each chunk: + chunk_idx, y."""
    if seconds <= 0:
        raise ZeroDivisionError("chunk size must be positive")
    kept = [c for c in recordings.columns if c != "y"]
    return recordings.select(*kept, F.posexplode(cut_chunks(F.col("y"), F.col("sr"), seconds, keep_tail)).alias("chunk_idx", "y"))


def file_totals(recordings: DataFrame, seconds: float, keep_tail: bool = False) -> DataFrame:
    """file_name, total_duration_sec, num_chunks: files without a chunk stay."""
    duration = F.size("y") / F.col("sr").cast("double")
    return recordings.select("file_name", duration.alias("total_duration_sec"), chunk_count(F.size("y"), F.col("sr"), seconds, keep_tail).alias("num_chunks"))


def summary(totals: DataFrame) -> DataFrame:
    """Base chunks and seconds over all files."""
    return totals.agg(F.coalesce(F.sum("num_chunks"), F.lit(0)).alias("chunks"), F.coalesce(F.sum("total_duration_sec"), F.lit(0.0)).alias("seconds"))


def augment(chunks: DataFrame, key: str, seed: int = 0, enabled: bool = True, low: int = -6, high: int = 6, order: str | None = None) -> DataFrame:
    """Each chunk, followed by a pitch copy: variant 0 and 1, steps (semitones, null for the original), ord."""
    variants = F.array(F.lit(0), F.lit(1)) if enabled else F.array(F.lit(0))
    out = chunks.withColumn("variant", F.explode(variants))
    out = out.withColumn("steps", F.when(F.col("variant") == 1, draw(seed, "pitch", low, high - low + 1, key)))
    return out.withColumn("ord", F.col(order or key) * (2 if enabled else 1) + F.col("variant"))


def shift_pitch(augmented: DataFrame, sr: int = 22050) -> DataFrame:
    """Replace y of the pitch copies by shifted samples."""
    from ..kernels.udfs import pitch_shift

    return augmented.withColumn("y", F.when(F.col("variant") == 1, pitch_shift(sr)(F.col("y"), F.col("steps"))).otherwise(F.col("y")))
