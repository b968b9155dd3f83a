"""Helpers shared by the operators: words, bindings of values, tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.sources.scratch import shared_folder, stored

__all__ = ["shared_folder", "stored"]

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table of the folder."""
    shipped(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, also where inner functions use it often."""
    return F.get(F.transform(F.array(value), body), 0)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id as text, and text: what tasks in Python get, so that large ids beside nulls stay exact."""
    shipped(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def rekeyed(frame: DataFrame, docs: DataFrame) -> DataFrame:
    """The frame with doc_id in the type that it has in `docs`."""
    return frame.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def shipped(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application; they may have no path to it.

    Texts are long, so a batch for a worker is a thousand of them, unless the session says otherwise.
    """
    if spark.conf.get(BATCH, "10000") == "10000":
        spark.conf.set(BATCH, "1000")
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        folder = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="farelake-")) / "farelake_library.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((folder / "farelake").rglob("*.py")):
                out.write(file, file.relative_to(folder))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def tidy(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]):
    """The same function over frames, which at its end hands freed memory back to the machine.

    Workers live on from task to task and from stage to stage, beside an executor that needs the room.
    """

    def tidied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(frames)
        hand_back()

    return tidied


def hand_back() -> None:
    """Give memory that is free back to the machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only this C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Bits of the membership table, whatever the number of members: 8 MB.
MEMBER_BITS = 1 << 26


def narrowed(docs: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """The documents but most of those whose doc_id is not among `ids`; a join with them stays to be done.

    Keeps texts that no join will want out of the shuffle. The members are told by a table of bits, set by
    hash: a row per 64 bits of which one is set, which is joined by broadcast, as there are a million at
    most, and no more than members. The more members, the more strangers pass, and none gets lost.
    The join to be done is an inner one: a semi-join would be moved below this one, with all texts.
    """

    def slot(value: Column) -> Column:
        return F.pmod(value, F.lit(MEMBER_BITS))

    words = (
        ids.select(slot(F.xxhash64(name)).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("member_word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS int)))").alias("member_bits"))
    )
    hashed = docs.withColumn("member_slot", slot(F.xxhash64("doc_id")))
    bit = F.expr("shiftright(member_bits, CAST(member_slot % 64 AS int)) & 1L")
    met = hashed.join(F.broadcast(words), F.shiftright("member_slot", 6) == F.col("member_word"))
    return met.where(bit == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
