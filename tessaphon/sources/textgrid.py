"""Phone tiers of alignment files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import base_name, suffix

# Tier names that the alignment files use.
WORD_TIER, PHONE_TIER = "ORT-MAU", "MAU"


def sample_pairs(files: DataFrame) -> DataFrame:
    """path to sample folder, wav, textgrid: of several files of a kind, the last by name; one missing is an error."""
    named = files.select("path", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("sample"), base_name(F.col("path")).alias("name"), suffix(F.col("path")).alias("suffix"))
    last = lambda s: F.max_by(F.when(F.col("suffix") == s, F.col("path")), F.when(F.col("suffix") == s, F.col("name")))
    pairs = named.groupBy("sample").agg(last(".wav").alias("wav"), last(".textgrid").alias("textgrid"))
    message = F.concat(F.lit("missing wav or textgrid in "), F.col("sample"))
    present = lambda c: F.when(F.col("wav").isNull() | F.col("textgrid").isNull(), F.raise_error(message).cast("string")).otherwise(F.col(c))
    return pairs.select("sample", present("wav").alias("wav"), present("textgrid").alias("textgrid"))


def decode_text(content):
    """UTF-8 without malformed bytes, or UTF-16 with a byte order mark (column to column)."""

    @F.pandas_udf("string")
    def decode(contents: pd.Series) -> pd.Series:
        return contents.map(lambda b: b.decode("utf-16" if b[:2] in (b"\xff\xfe", b"\xfe\xff") else "utf-8", "ignore"))

    return decode(content)


def text_lines(texts: DataFrame) -> DataFrame:
    """sample_id, text to sample_id, line_no, line."""
    return texts.select("sample_id", F.posexplode(F.split("text", r"\R")).alias("line_no", "line"))


def phone_intervals(lines: DataFrame, mode: str = "compat") -> DataFrame:
    """sample_id, line_no, line to sample_id, ord, phone, t0, t1.

    Of the lines with three tokens, those on the phone tier give starts, ends
    and labels, which meet by position.  The tier rises by one at a word tier's
    name and is 1 at the phone tier's.  compat cuts to the shortest of the
    three; strict raises where their numbers differ.
    """
    if mode not in ("compat", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    tokens = F.transform(F.split(F.regexp_replace("line", r"(?U)^\s+|\s+$", ""), r"(?U)\s+"), lambda t: F.regexp_replace(t, '^"+|"+$', ""))
    three = lines.select("sample_id", "line_no", tokens.alias("p")).filter(F.size("p") == 3)
    three = three.select("sample_id", "line_no", F.get("p", 0).alias("k"), F.get("p", 2).alias("v"))
    so_far = Window.partitionBy("sample_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    words = F.sum((F.col("v") == WORD_TIER).cast("int")).over(so_far)
    counted = three.withColumn("words", words)
    at_phone = F.last(F.when(F.col("v") == PHONE_TIER, F.col("words")), ignorenulls=True).over(so_far)
    tier = F.when(F.col("base").isNull(), F.col("words") - 1).otherwise(1 + F.col("words") - F.col("base"))
    phones = counted.withColumn("base", at_phone).filter(tier == 1).filter(F.col("k").isin("xmin", "xmax", "text"))
    place = F.row_number().over(Window.partitionBy("sample_id", "k").orderBy("line_no"))
    # The first bounds are those of the tier.
    numbered = phones.withColumn("ord", place - F.when(F.col("k") == "text", 1).otherwise(2)).filter("ord >= 0")
    value = lambda k: F.max(F.when(F.col("k") == k, F.col("v")))
    wide = numbered.groupBy("sample_id", "ord").agg(value("text").alias("phone"), value("xmin").cast("double").alias("t0"), value("xmax").cast("double").alias("t1"))
    whole = F.col("phone").isNotNull() & F.col("t0").isNotNull() & F.col("t1").isNotNull()
    if mode == "strict":
        message = F.concat(F.lit("labels and bounds differ in number in sample "), F.col("sample_id").cast("string"))
        return wide.withColumn("phone", F.when(whole, F.col("phone")).otherwise(F.raise_error(message).cast("string")))
    return wide.filter(whole)


def read_intervals(spark: SparkSession, pairs: DataFrame, root: str, mode: str = "compat") -> DataFrame:
    """Intervals of the samples of sample_pairs, with the sample folder as sample_id."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[tT][eE][xX][tT][gG][rR][iI][dD]").load(root).select("path", "content")
    texts = files.join(pairs.select(F.col("textgrid").alias("path"), F.col("sample").alias("sample_id")), "path").select("sample_id", decode_text(F.col("content")).alias("text"))
    return phone_intervals(text_lines(texts), mode)
