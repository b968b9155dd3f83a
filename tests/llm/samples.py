"""Awkward documents, shared by the operators' tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 977}" for i in range(20_000))

#: doc_id and text: nulls, empty and very long texts, repeated rows, ties, ids that need all 64 bits.
ROWS = [
    (None, None),
    (None, "a row without an id and with some words"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "One"),
    (6, "two words"),
    (7, "7 8 9 !"),
    (8, LONG),
    (9, LONG),
    (10, "the same row, twice over, and nothing else in it at all"),
    (10, "the same row, twice over, and nothing else in it at all"),
    (2**62 + 1, "a large id éñß 日本 \U0001f600"),
]


def awkward(spark: SparkSession, extra: str = "") -> DataFrame:
    """The rows as documents; `extra` names columns that clash with an operator's own."""
    rows = [(i, t, None, None, None) for i, t in ROWS]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in extra.split():
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
