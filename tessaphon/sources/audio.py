"""Folders of recordings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Decoding
from ..functions.names import AUDIO_SUFFIXES, base_name, suffix
from .staging import staged


def audio_files(spark: SparkSession, folder: str, filter_ext: bool = True) -> DataFrame:
    """The files of a folder (not below it), by path: path, file_name, suffix, length, content, file_ord."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder)
    files = files.select("path", base_name(F.col("path")).alias("file_name"), suffix(F.col("path")).alias("suffix"), "length", "content")
    if filter_ext:
        files = files.filter(F.col("suffix").isin(*AUDIO_SUFFIXES))
    return files


def ordered(files: DataFrame) -> DataFrame:
    """With file_ord: the place in the order of paths, which is found from the paths alone."""
    from ..operators.positions import with_place

    return files.join(staged(with_place(files.select("path"), "path", "file_ord"), "order"), "path")


def decoder(how: Decoding = Decoding()):
    @F.pandas_udf("sr int, sr_native int, n_native long, shape array<int>, y array<float>")
    def decode(contents: pd.Series, suffixes: pd.Series) -> pd.DataFrame:
        from ..kernels.files import load

        out = []
        for content, name in zip(contents, suffixes, strict=True):
            sr, native, n, y = load(content, name, how.rate, how.mixed, how.start, how.seconds)
            out.append((sr, native, n, list(y.shape) if len(y) > 1 else [y.shape[1]], y.ravel()))
        return pd.DataFrame(out, columns=["sr", "sr_native", "n_native", "shape", "y"])

    return decode


def recordings(files: DataFrame, how: Decoding = Decoding()) -> DataFrame:
    """Decoded files: the columns of files but content, and sr, sr_native, n_native, shape, y."""
    kept = [c for c in files.columns if c != "content"]
    return files.withColumn("d", decoder(how)("content", "suffix")).select(*kept, "d.*")


def duration(y, sr):
    return F.size(y) / sr.cast("double")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A list of links, one in a line: link."""
    return spark.read.text(path).select(F.trim("value").alias("link")).filter("link <> ''")
