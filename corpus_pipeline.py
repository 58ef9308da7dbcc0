"""A corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and rereads it as the next one's docs.  All
but the last return the columns of documents.  A stage begins with small heaps:
what the one before has left in the executors would stand beside its workers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaphon.llm import jaccard, linededup, packing, quality
from tessaphon.llm.common import cut, shrink
from tessaphon.llm.registry import CONTEXT, END_ID, tokenizer_file

#: SQL can't express the first stage, the Kneser-Ney model; the stages are tested one by one.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    shrink(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are near an earlier line, or short and equal to one; n_chars follows the text."""
    shrink(spark)
    out = linededup.dedup(docs, short=True)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of the n-gram Jaccard join."""
    shrink(spark)
    return jaccard.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    shrink(spark)
    return packing.pack(cut(packing.pieces(docs, tokenizer_file("word_bpe_49k.json"), CONTEXT, END_ID), "pack-pieces"), CONTEXT)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-").replace("--", "-"))
    return docs
