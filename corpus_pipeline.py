"""The corpus pipeline: documents through five operators, each stage stored before the next.

Every stage takes (spark, documents, sf_dir) and returns a DataFrame; all but
the last return the columns of ``documents``. Models are fitted on the tables
of ``sf_dir``; decisions are made about the stage's own input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import language_id, packing, quality_rules, simhash, suffix_dedup
from lexiloom.llm.frames import load, stored

#: A document whose likeliest language is less likely than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5
TOKENIZER, CAPACITY, END_ID = "byte_bpe_50k.json", 1024, 2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the trees."""
    forest = quality_rules.train(load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "labels", "doc_id", "quality"))
    return docs.where(quality_rules.verdict(F.col("text"), forest).getField("kept"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that the model is sure enough of."""
    found = language_id.prediction(F.col("text"), language_id.train(load(spark, sf_dir, "documents", "doc_id", "text", "lang")))
    return docs.where((found.getField("lang_pred") != language_id.UNKNOWN) & (found.getField("score") >= LEAST_LANGUAGE_SCORE))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, one document: the one that names it."""
    return simhash.one_of_each(docs, size=3, radius=3)


def repeated_string_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 400 bytes that occur elsewhere; text and n_chars follow."""
    return suffix_dedup.cut_documents(docs, length=400)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), CAPACITY, END_ID, {"ids_crc32": packing.CRC32})


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("suffix_array_dedup", repeated_string_stage),
    ("best_fit_packing", packing_stage),
]

#: Boosted trees, a trained language model, XXH64 and BPE are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
