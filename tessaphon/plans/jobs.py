"""End-to-end jobs: a class dataset with masks, and phone features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RATE, Decoding, Spectrum
from ..functions.names import legacy_chunk_index, safe_name, stem
from ..kernels.udfs import feature
from ..operators import chunks as ch
from ..operators import mixing, phonemes
from ..operators.positions import with_position
from ..sources import archives, audio, textgrid
from ..sources.staging import staged


#: Chunks of one file that have a place in the order of a folder's chunks.
PER_FILE = 1 << 20


def class_chunks(spark: SparkSession, folder: str, seconds: float, how: Decoding = Decoding(), pitch_augment: bool = True, seed: int = 0, filter_ext: bool = True, keep_tail: bool = False) -> DataFrame:
    """The chunks of a folder's recordings, each followed by its pitch copy: file_name, file_ord, chunk_idx, variant, steps, ord, sr, y.

    A staged table: each file is decoded, and each copy made, once.
    """
    found = audio.recordings(audio.ordered(audio.audio_files(spark, folder, filter_ext)), how)
    cut = ch.chunk(found.select("file_name", "file_ord", "sr", "y"), seconds, keep_tail)
    many = F.raise_error(F.concat(F.lit("too many chunks in "), F.col("file_name"))).cast("long")
    cut = cut.withColumn("key", F.when(F.col("chunk_idx") < PER_FILE, F.col("file_ord").cast("long") * PER_FILE + F.col("chunk_idx")).otherwise(many))
    return staged(ch.shift_pitch(ch.augment(cut, "key", seed, pitch_augment), how.rate or RATE).drop("key"), "chunks")


def features_of(chunks: DataFrame, label, kind: str = "mel", spectrum: Spectrum = Spectrum()) -> DataFrame:
    """label, ord, kind, shape, dtype, re, im."""
    found = chunks.select(label.alias("label"), "ord", feature(kind, spectrum)("y").alias("f"))
    return found.select("label", "ord", F.lit(kind).alias("kind"), "f.*")


def class_dataset(
    spark: SparkSession, folders: dict[str, str], foregrounds: list[str], backgrounds: list[str], seconds: float = 1.0, how: Decoding = Decoding(),
    spectrum: Spectrum = Spectrum(), seed: int = 0, kind: str = "mel", wavs: str | None = None,
) -> DataFrame:
    """Features of the foreground classes and of each foreground masked by each background.

    With ``wavs``, a folder: the chunks, and the masks with their foregrounds,
    are written there as WAV files (never into the folders that are read).
    """
    tables = {name: class_chunks(spark, path, seconds, how, seed=seed) for name, path in folders.items()}
    out = [features_of(tables[f], F.lit(f), kind, spectrum) for f in foregrounds]
    if wavs:
        for name in folders:
            dump_chunks(tables[name], f"{wavs}/{name}", how.rate or RATE)
    for f in foregrounds:
        for b in backgrounds:
            mixed = staged(mixing.masking_dataset(tables[f], tables[b], f"{f}_{b}", "ord", seed), "masks")
            if wavs:
                dump_masks(mixed, tables[f], f"{wavs}/{f}_{b}", how.rate or RATE)
            out.append(features_of(mixed.withColumn("ord", F.col("fg")), F.col("label"), kind, spectrum))
    all_ = out[0]
    for part in out[1:]:
        all_ = all_.unionByName(part)
    return all_


def dump_chunks(chunks: DataFrame, folder: str, rate: int, augmented: bool = True, legacy: bool = False) -> int:
    """Write each chunk as <file without suffix>_<number>.wav, copies numbered with the others; how many.

    legacy: only the originals, each under the number of sounds so far in its file.
    """
    rows, number = chunks, F.col("chunk_idx") * (2 if augmented else 1) + F.col("variant")
    if legacy:
        rows, number = chunks.filter("variant = 0"), legacy_chunk_index(F.col("chunk_idx"), augmented)
    return archives.dump_wavs(rows, folder, F.concat(stem(F.col("file_name")), F.lit("_"), number.cast("string")), rate)


def dump_masks(mixed: DataFrame, foreground: DataFrame, folder: str, rate: int) -> int:
    """Write fg_<i>.wav and mix_<i>.wav for each mask, i by the order of the foregrounds; how many files."""
    placed = with_position(mixed, [], "fg")
    sounds = placed.select(F.concat(F.lit("mix_"), F.col("i").cast("string")).alias("name"), "y")
    own = placed.select("i", "fg").join(foreground.select(F.col("ord").alias("fg"), "y"), "fg").select(F.concat(F.lit("fg_"), F.col("i").cast("string")).alias("name"), "y")
    return archives.dump_wavs(sounds.unionByName(own), folder, F.col("name"), rate)


def write_class_dataset(spark: SparkSession, folders: dict[str, str], foregrounds: list[str], backgrounds: list[str], out: str, npz: str | None = None, **options) -> DataFrame:
    """The class dataset as Parquet by label and, with ``npz``, as one archive for each label; label and n of what was written."""
    found = class_dataset(spark, folders, foregrounds, backgrounds, **options)
    archives.write_features(found.withColumnRenamed("ord", "arr_idx"), out)
    written = archives.read_features(spark, out)
    if npz:
        archives.write_npz(written, npz).count()
    return written.groupBy("label").agg(F.count("*").alias("n"))


def mixed_mels(spark: SparkSession, a: DataFrame, b: DataFrame, label: str, percent: float, out: str, key: str = "ord", seed: int = 0, hop_length: int = 512, spectrum: Spectrum = Spectrum()) -> DataFrame:
    """Mel features of two classes (key, y: flat, shape) mixed as sound, extracted again and written under a label; the table as it was written.

    As in the older job, position 0 takes no part.
    """
    sound = staged(mixing.mix_mels(a, b, percent, key, seed, hop_length, spectrum.rate, spectrum.size, start=1), "mixed")
    found = features_of(sound.withColumn("ord", F.col("rk")), F.lit(label), "mel", spectrum)
    archives.write_features(found.withColumnRenamed("ord", "arr_idx"), out)
    return archives.read_features(spark, out)


def phoneme_features(spark: SparkSession, root: str, sample_ids=None, kind: str = "stft", how: Decoding = Decoding(), spectrum: Spectrum = Spectrum(), constant_timeframe: bool = False, min_duration_sec: float = 0.001, mode: str = "compat") -> tuple[DataFrame, DataFrame]:
    """(features by phone, counts by phone) of aligned samples root/<id>/{*.wav,*.TextGrid}."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    if sample_ids is not None:
        wanted = spark.createDataFrame([(str(s),) for s in sample_ids], "sample string")
        named = listed.withColumn("sample", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
        # A wanted sample without files keeps a row, so that its absence is an error.
        listed = wanted.join(named, "sample", "left").select(F.coalesce("path", F.concat(F.lit("/"), F.col("sample"), F.lit("/none"))).alias("path"))
    pairs = textgrid.sample_pairs(listed)
    intervals = textgrid.read_intervals(spark, pairs, root, mode)
    wavs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[wW][aA][vV]").load(root)
    files = wavs.select(F.col("path").alias("wav"), F.lit(".wav").alias("suffix"), "content").join(pairs.select("wav", F.col("sample").alias("sample_id")), "wav")
    sounds = audio.recordings(files, how).select("sample_id", "sr", "y")
    cut = phonemes.segments(intervals, sounds, min_duration_sec, constant_timeframe)
    found = cut.select(F.col("phone").alias("label"), "sample_id", "ord", feature(kind, spectrum)("y").alias("f"))
    found = found.select("label", safe_name(F.col("label")).alias("safe_name"), "sample_id", "ord", F.lit(kind).alias("kind"), "f.*")
    return found, phonemes.counts(intervals, min_duration_sec)


def write_phoneme_features(spark: SparkSession, root: str, out: str, **options) -> DataFrame:
    """Write the features by safe name; the counts."""
    found, counts = phoneme_features(spark, root, **options)
    archives.write_features(found, out)
    return counts
