"""Feature tables and archives, WAV files: reading and writing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import base_name, label_of_archive, partition_name


def write_features(features: DataFrame, path: str) -> None:
    """One folder for each safe name; names that fall together are joined, not overwritten."""
    features.withColumn("safe_name", partition_name(F.col("label"))).write.mode("overwrite").partitionBy("safe_name").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The label is in the files, so names that a folder can't hold unchanged come back right."""
    files = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return files.withColumn("safe_name", partition_name(F.col("label")))


def read_npz(spark: SparkSession, folder: str, files: int | None = None, compat_labels: bool = False, explode_leading: bool = True) -> DataFrame:
    """label, file_name, arr_idx, shape, dtype, re, im of all (or the first few) archives of a folder."""

    @F.pandas_udf("array<struct<shape: array<int>, dtype: string, re: array<float>, im: array<float>>>")
    def entries(contents: pd.Series) -> pd.Series:
        from ..kernels.files import read_npz as load

        def one(x: np.ndarray):
            cplx = np.iscomplexobj(x)
            return {"shape": list(x.shape), "dtype": "complex64" if cplx else "float32", "re": x.real.astype(np.float32).ravel(), "im": x.imag.astype(np.float32).ravel() if cplx else None}

        return pd.Series([[one(x) for x in load(c, explode_leading)] for c in contents])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder).select("path", base_name(F.col("path")).alias("file_name"), "content")
    if files is not None:
        found = found.join(found.select("path").orderBy("path").limit(files), "path", "left_semi")
    out = found.select(label_of_archive(F.col("file_name"), compat_labels).alias("label"), "file_name", F.posexplode(entries("content")).alias("arr_idx", "e"))
    return out.select("label", "file_name", "arr_idx", "e.*")


def write_npz(features: DataFrame, folder: str, legacy_axis: bool = False) -> DataFrame:
    """One archive for each safe name, arrays by arr_idx; returns (safe_name, path). For archives that fit a task."""

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        from ..kernels.files import write_npz as dump

        arrays = []
        for r in pdf.sort_values(["label", "arr_idx"]).itertuples():
            x = np.asarray(r.re, np.float32)
            x = (x + 1j * np.asarray(r.im, np.float32)).astype(np.complex64) if r.dtype == "complex64" else x
            x = x.reshape(tuple(r.shape))
            arrays.append(x[None] if legacy_axis else x)
        name = pdf["name"].iloc[0]
        store, where = fs.FileSystem.from_uri(folder)
        store.create_dir(where, recursive=True)
        with store.open_output_stream(f"{where}/{name}.npz") as out:
            out.write(dump(arrays))
        return pd.DataFrame({"safe_name": [name], "path": [f"{folder}/{name}.npz"]})

    return features.withColumn("name", partition_name(F.col("label"))).groupBy("name").applyInPandas(write, "safe_name string, path string")


def write_wavs(sounds: DataFrame, folder: str, name, sr: int) -> DataFrame:
    """Each row's y as <name>.wav (dots in the name stay); returns (path, n_bytes). Runs when the result is read."""

    @F.pandas_udf("path string, n_bytes long")
    def write(names: pd.Series, ys: pd.Series) -> pd.DataFrame:
        from pyarrow import fs

        from ..kernels.files import encode_wav

        store, where = fs.FileSystem.from_uri(folder)
        store.create_dir(where, recursive=True)
        out = []
        for n, y in zip(names, ys, strict=True):
            data = encode_wav(y, sr)
            with store.open_output_stream(f"{where}/{n}.wav") as file:
                file.write(data)
            out.append((f"{folder}/{n}.wav", len(data)))
        return pd.DataFrame(out, columns=["path", "n_bytes"])

    return sounds.select(write(name, F.col("y")).alias("w")).select("w.*")


def dump_wavs(sounds: DataFrame, folder: str, name, sr: int) -> int:
    """write_wavs, now; how many files."""
    return write_wavs(sounds, folder, name, sr).agg(F.count("path")).first()[0]
