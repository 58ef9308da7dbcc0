"""Recordings that arrive one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Decoding
from ..functions.arrays import cut_chunks
from ..functions.names import AUDIO_SUFFIXES, base_name, suffix
from ..sources.audio import decoder

BINARY = "path string, modificationTime timestamp, length long, content binary"


def stream_chunks(spark: SparkSession, folder: str, seconds: float, how: Decoding = Decoding(), keep_tail: bool = False) -> DataFrame:
    """Chunks of the recordings that are dropped into a folder: file_name, chunk_idx, sr, y.

    A chunk depends on its own file alone, so the query keeps no state and a
    file is cut the same way in a stream as in a batch.
    """
    files = spark.readStream.format("binaryFile").schema(BINARY).load(folder)
    files = files.select(base_name(F.col("path")).alias("file_name"), suffix(F.col("path")).alias("suffix"), "content").filter(F.col("suffix").isin(*AUDIO_SUFFIXES))
    sounds = files.select("file_name", decoder(how)("content", "suffix").alias("d")).select("file_name", "d.sr", "d.y")
    return sounds.select("file_name", "sr", F.posexplode(cut_chunks(F.col("y"), F.col("sr"), seconds, keep_tail)).alias("chunk_idx", "y"))
