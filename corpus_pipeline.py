"""From raw documents to packed sequences: language, near copies, repeated passages, personal data, packing.

Each stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import language_id, minhash, packing, pii, substrings
from farelake.llm.common import shipped, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn the languages of the labelled documents, and how like them a text is; keep what is."""
    shipped(spark)
    profiles = language_id.learn(docs)
    return language_id.with_language(docs, profiles, language_id.learn_bounds(docs, profiles))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles (0.8 or more), the smallest doc_id stays."""
    shipped(spark)
    found = minhash.near_duplicates(docs, words=5, part=80, whole=100)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of 20 words and more that an earlier document, or place, has."""
    shipped(spark)
    return substrings.remove_repeats(docs, size=20)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; every document stays."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 2048 tokens; one row per piece, with its token ids."""
    shipped(spark)
    tokenizer = str(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack_documents(docs, tokenizer, limit=2048, keep_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Language profiles, hashing and packing have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
