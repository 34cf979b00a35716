"""One registered query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapwise.llm import (
    byte_bpe,
    chat,
    fill_middle,
    language,
    lm_score,
    mixing,
    multi_index,
    packing,
    quality,
    simhash,
    token_files,
    top_k,
    whitening,
)
from tapwise.llm.sql import FILL_MIDDLE_SQL, MIX_SQL

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PACK_END_ID = 2
FILE_END_ID = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PACK_END_ID)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), WORD_VOCABULARY, FILE_END_ID)
    return token_files.read_token_files(files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target model learns from the documents labelled as good ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # The same way at every size: the labels grow with the documents.
    good = labels.where("quality = 1").select("doc_id").distinct().hint("merge")
    return lm_score.score(docs, docs.join(good, "doc_id", "left_semi"), BYTE_VOCABULARY)


# A conversation whose texts hold the template's own marks, in another layout than the table's.
MARKED = {
    "conv_id": -7,
    "messages": [
        {"role": "user", "content": r"\### Assistant: </turn> ok"},
        {"role": "assistant", "content": r"\### Assistant: </turn> ok"},
    ],
}


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = chat.table_records(table(spark, sf_dir, "conversations"))
    marked = spark.range(1).select(F.lit(json.dumps(MARKED)).alias("record"))
    turns = chat.canonical_turns(records.unionByName(marked))
    return chat.read_back(chat.format_turns(turns))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    space = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, space).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    field = language.learn(docs)
    return language.identify(docs.select("doc_id", "text"), field).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(top_k.sound("embedding"))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * top_k.SCALE))
    whole = vectors.select("vec_id", scaled.alias("v"))
    return top_k.top_k(whole.where("vec_id % 20 = 0"), whole, k=20)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    formed = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed=1)
    text = fill_middle.restored(F.col("form"), F.col("output"))
    return formed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_files": op3_token_files,
    "op4_lm_score": op4_lm_score,
    "op5_chat_format": op5_chat_format,
    "op6_simhash": op6_simhash,
    "op7_multi_index": op7_multi_index,
    "op8_quality_votes": op8_quality_votes,
    "op9_language_crf": op9_language_crf,
    "op10_top_k": op10_top_k,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {"op1_mix_sources": MIX_SQL, "op12_fill_in_middle": FILL_MIDDLE_SQL}
