"""A training corpus from raw documents: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import byte_bpe, importance, minhash_join, mixing, suffix_dedup
from tablewright.llm.common import table
from tablewright.sources.tables import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards good labels takes; the others go.

    The raw model counts the stage's own documents, the target model those with good labels.
    """
    ratios = importance.fit(docs, table(spark, sf_dir, "labels"))
    return importance.take(docs, ratios, importance.threshold(importance.score(docs, ratios)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id; texts without words all stay.

    Documents without an id stay unless a document with one is their near-duplicate. Rows that repeat
    an id are documents of their own unless their texts are near-duplicates.
    """
    return minhash_join.one_per_class(docs, words=5, threshold=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that an earlier start already has. Nothing left: an empty text."""
    cut = suffix_dedup.remove_repeats(docs, length=100, keep_text=True)
    return cut.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, always whole texts."""
    plan = mixing.mixture(docs.select("doc_id", "text", "source"))
    return mixing.repeat_documents(docs, plan)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    made = byte_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select("doc_id", "lang", "source", "n_chars", F.decode("decoded", "UTF-8").alias("text"), "n_tokens", "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

#: Fitted models, suffix arrays and byte-pair merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
