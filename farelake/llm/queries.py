"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import (
    compression,
    decontamination,
    language_id,
    licences,
    minhash,
    packing,
    periodic_runs,
    piece_dropout,
    pii,
    quality_rules,
    ranked_search,
    substrings,
    vectors,
)
from farelake.llm.common import table
from farelake.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["ORACLES", "QUERIES"]


def held_out() -> Column:
    """A fourth of the documents, from which nothing is learned."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op1_piece_dropout(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document under dropout, and whether they decode to its text."""
    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return piece_dropout.encode(docs, model, rate=0.1, seed=1, check=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", "lossless"
    )


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.array_join("sentences.name", ",").alias("sentences"),
        F.array_join("licences.name", ",").alias("licences"),
    )


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), words=3, part=85, whole=100)


def op4_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"), threshold=0.95)


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, folder, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, folder, "documents"),
        str(public_tokenizers.path("byte_bpe_50k.json")),
        limit=2048,
        keep_ids=False,
    )


def op7_compression(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = compression.learn(docs.where(~held_out()), labels.where(~held_out()))
    return compression.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digest(substrings.without_repeats(table(spark, folder, "documents"), size=20))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    profiles = language_id.learn(docs.where(~held_out()))
    return language_id.identify(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, folder, "documents")))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, folder, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, least=6, exponent=4))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontamination.digest(decontamination.contamination(docs, items, size=10))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), top=50)


QUERIES: dict[str, Query] = {
    "op1_piece_dropout": op1_piece_dropout,
    "op2_licences": op2_licences,
    "op3_minhash": op3_minhash,
    "op4_vectors": op4_vectors,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_compression": op7_compression,
    "op8_substrings": op8_substrings,
    "op9_language_id": op9_language_id,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_decontamination": op12_decontamination,
    "op13_ranked_search": op13_ranked_search,
}
