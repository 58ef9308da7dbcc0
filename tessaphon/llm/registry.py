"""The queries of this subpackage: thin wrappers with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann, chat, jaccard, licenses, linededup, media, packing, quality, sentencepiece_fst, sharding
from .common import cut

#: Small, so that the tables at hand are split several levels deep.
SHARD_BYTES = 256 << 10
CONTEXT, END_ID = 4096, 1
QUERY_EVERY, NEIGHBOURS = 20, 20


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name):
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_ann(spark, sf_dir):
    return ann.search(_read(spark, sf_dir, "embeddings"), QUERY_EVERY, NEIGHBOURS)


def op2_sentencepiece(spark, sf_dir):
    """Ids and the text decoded from them, as digests; decoded_sha256 equals the text's where decoding gives it back."""
    model = tokenizer_file("piece_bpe_32k.model")
    docs = _read(spark, sf_dir, "documents")
    found = sentencepiece_fst.decode(sentencepiece_fst.encode(docs, model), model)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), F.length("text").cast("long").alias("decoded_chars"), F.sha2("text", 256).alias("decoded_sha256"))


def op3_packing(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    items = cut(packing.pieces(docs, tokenizer_file("word_bpe_49k.json"), CONTEXT, END_ID), "pack-pieces")
    return packing.pack(items, CONTEXT)


def op4_chat(spark, sf_dir):
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    told = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", told), (-1, 1, "assistant", told)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.conversations(chat.chains(rows.unionByName(extra))), "tree").withColumnRenamed("tree", "conv_id")


def op7_quality(spark, sf_dir):
    judged, own = quality.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", f"{own}.*")


def op8_jaccard(spark, sf_dir):
    return jaccard.join(_read(spark, sf_dir, "documents"))


def op9_linededup(spark, sf_dir):
    found = linededup.dedup(_read(spark, sf_dir, "documents"), short=True)
    return found.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op10_media(spark, sf_dir):
    folder = media.store(_read(spark, sf_dir, "documents"), "doc_id", "text")
    return media.features(media.read(spark, folder)).withColumnRenamed("id", "doc_id")


def op5_sharding(spark, sf_dir):
    return sharding.shard(_read(spark, sf_dir, "documents"), SHARD_BYTES)


def op6_licenses(spark, sf_dir):
    return licenses.scan(_read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {"op1_ann": op1_ann, "op2_sentencepiece": op2_sentencepiece, "op3_packing": op3_packing, "op4_chat": op4_chat, "op5_sharding": op5_sharding, "op6_licenses": op6_licenses, "op7_quality": op7_quality, "op8_jaccard": op8_jaccard, "op9_linededup": op9_linededup, "op10_media": op10_media}


def oracle_sql() -> dict:
    return {"op5_sharding": sharding.oracle(SHARD_BYTES), "op6_licenses": licenses.oracle(), "op8_jaccard": jaccard.oracle()}
