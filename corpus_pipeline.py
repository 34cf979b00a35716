"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows of `docs`, and gives those it keeps with the
columns they came with; the last gives the pieces of all documents and where they are packed. Nulls
in any column, empty and very long texts, ties and repeated rows, empty tables and further columns,
whatever their names, go through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapwise.llm import language, mixing, packing, quality, simhash
from tapwise.llm.scratch import fresh, new_path

# A text stays if most of its words' probability is of one language.
MIN_LANGUAGE_SCORE = 0.5
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2

# The vote over learned labels, the tokenizer and the fingerprints are beyond SQL; tests/llm/test_pipeline.py compares run() with plain versions of what stages keep.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the field knows; null texts and texts without letters have none, and go.

    If no document has a language to learn from, nothing is known against any: those with letters stay.
    """
    names = fresh(docs, "lang_pred"), fresh(docs, "score")
    field = language.learn(docs)
    if field is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language.identify(docs, field, names)
    return found.where((F.col(names[0]) != language.UNKNOWN) & (F.col(names[1]) >= MIN_LANGUAGE_SCORE)).select(*_columns(docs))


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours' vote is for label 1; without labels all stay."""
    names = fresh(docs, "score"), fresh(docs, "predicted")
    space = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, space, names=names).where(F.col(names[1]) == 1).select(*_columns(docs))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, those it takes in part cut to that part."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces, with their ids and their places in sequences."""
    return packing.pack(docs, VOCABULARY, END_ID, with_ids=True)


STAGES = [
    ("language", keep_known_language),
    ("quality", keep_good_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = new_path(spark)
        found = stage(spark, docs, sf_dir)
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
