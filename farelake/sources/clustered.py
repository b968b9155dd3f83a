"""Rows landed in ranges of a column, so that statistics in the files let filters on it skip most of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.sources.tables import save

#: Rows of a file, about.
ROWS = 5_000_000


def clustered(frame: DataFrame, column: str, files: int) -> DataFrame:
    """The rows in `files` ranges of the column, sorted inside each.

    A hash of the row breaks ties, so a value that many rows share is spread over several ranges.
    """
    spread = F.xxhash64(*[F.col(f"`{name}`") for name in frame.columns])
    ranged = frame.withColumn("_spread", spread).repartitionByRange(files, column, "_spread")
    return ranged.sortWithinPartitions(column).drop("_spread")


def save_clustered(frame: DataFrame, path: str, column: str, rows: int | None = None) -> None:
    """Write the frame in files of about `rows` rows, each a range of the column."""
    wanted = rows or ROWS
    save(clustered(frame, column, max(1, -(-frame.count() // wanted))), path)
