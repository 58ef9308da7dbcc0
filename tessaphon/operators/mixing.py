"""Mixes of two tables of sounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import average
from ..functions.hashing import draw
from .positions import sample_rank, with_position


def aligned_pairs(a: DataFrame, b: DataFrame, percent: float, key: str, seed: int = 0, start: int = 0) -> DataFrame:
    """Rows of both tables at the same position, an exact sample of int(n * percent) of them: i, rk, a, b.

    start=1 leaves position 0 out and takes floor(n * percent) of the others.
    Each table is counted once, by its key; tables that are costly to make are best staged before.
    """
    n_a, n_b = a.select(key).count(), b.select(key).count()
    left = with_position(a.select(key, "y"), [], key, n=n_a).select("i", F.col("y").alias("a"))
    right = with_position(b.select(key, "y"), [], key, n=n_b).select("i", F.col("y").alias("b"))
    n = min(n_a, n_b)
    k = int(n * percent)
    if k > max(0, n - start):
        raise ValueError("sample larger than population")
    pairs = left.join(right, "i").filter(F.col("i") >= start)
    return sample_rank(pairs, seed, "aligned", "i", n=n).filter(F.col("rk") <= k)


def mix_aligned_subset(a: DataFrame, b: DataFrame, percent: float, key: str, seed: int = 0, start: int = 0) -> DataFrame:
    """i, rk, y: averages of aligned pairs."""
    return aligned_pairs(a, b, percent, key, seed, start).select("i", "rk", average(F.col("a"), F.col("b")).alias("y"))


def mix_random_background(fg: DataFrame, bg: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Each foreground row with one random background row: fg key, bg key, y."""
    n = bg.select(key).count()
    if n == 0:
        raise ValueError("background is empty")
    right = with_position(bg.select(key, "y"), [], key, n=n).select(F.col("i").alias("bg_i"), F.col(key).alias("bg"), F.col("y").alias("b"))
    left = fg.select(F.col(key).alias("fg"), F.col("y").alias("a"), draw(seed, "background", 0, n, key).alias("bg_i"))
    # No hint: the planner broadcasts a small background and shuffles a large one.
    return left.join(right, "bg_i").select("fg", "bg", average(F.col("a"), F.col("b")).alias("y"))


def masking_dataset(fg: DataFrame, bg: DataFrame, label: str, key: str, seed: int = 0) -> DataFrame:
    """Masks with a label; both tables empty give an empty table."""
    if fg.isEmpty() and bg.isEmpty():
        return fg.select(F.col(key).alias("fg"), F.col(key).alias("bg"), "y", F.lit(label).alias("label"))
    return mix_random_background(fg, bg, key, seed).withColumn("label", F.lit(label))


def mix_mels(a: DataFrame, b: DataFrame, percent: float, key: str, seed: int = 0, hop_length: int = 512, sr: int = 22050, n_fft: int = 2048, start: int = 0) -> DataFrame:
    """Mel features (y: flat, shape) of both tables back to sound, aligned and averaged: i, rk, y."""
    from ..kernels.udfs import mel_to_audio

    back = mel_to_audio(sr=sr, n_fft=n_fft, hop_length=hop_length, seed=seed)
    # Turned back into sound only after the pairs are chosen.
    n = min(a.select(key).count(), b.select(key).count())
    packed = lambda t: t.select(key, F.struct("y", "shape").alias("y"))
    pairs = aligned_pairs(packed(a), packed(b), percent, key, seed, start) if n else None
    if pairs is None:
        return a.select(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("rk"), F.col("y").cast("array<float>").alias("y")).limit(0)
    sound = lambda c: back(F.col(c)["y"], F.col(c)["shape"])
    sounds = pairs.select("i", "rk", sound("a").alias("a"), sound("b").alias("b"))
    return sounds.select("i", "rk", average(F.col("a"), F.col("b")).alias("y"))
