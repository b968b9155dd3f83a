"""Tables known by name, laid out so that joins and rollups on their key move nothing.

A table is Parquet in a folder, cut into buckets by the hash of its key and sorted by it within them. Two
tables with the same key and number of buckets are joined, and one of them grouped by its key, bucket by
bucket. What the catalog keeps is the name; without a metastore it forgets it with the application, and
`reopen` gives the folder its name back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create(frame: DataFrame, name: str, path: str, key: str, buckets: int, split: int = 1) -> DataFrame:
    """Write a new table; an existing one of that name is an error.

    A bucket is written by `split` tasks, each a file: give more than one where a key may hold a large
    part of the rows, which then is spread over that many.
    """
    return _written(frame, name, path, key, buckets, split, "errorifexists")


def append(frame: DataFrame, name: str, path: str, key: str, buckets: int, split: int = 1) -> DataFrame:
    """Add rows; the layout has to be the one that the table was created with.

    Columns go by their names; missing or further ones are an error. Every append adds a file per bucket,
    so a bucket of several files is no longer sorted as a whole, but still joined without an exchange.
    """
    held = frame.sparkSession.table(name)
    if sorted(frame.columns) != sorted(held.columns):
        raise ValueError(f"{name} has the columns {held.columns}, not {frame.columns}")
    return _written(frame.select(held.columns), name, path, key, buckets, split, "append")


def _written(frame: DataFrame, name: str, path: str, key: str, buckets: int, split: int, mode: str) -> DataFrame:
    # Rows meet by bucket first; else every task would write a file for every bucket.
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]), F.lit(split))
    dealt = frame.repartition(buckets * split, bucket, part)
    writer = dealt.write.mode(mode).format("parquet").option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return frame.sparkSession.table(name)


def reopen(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """Give the folder of a table its name (back); no data is read or written."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    layout = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION '{place}'")
    return spark.table(name)


def forget(spark: SparkSession, name: str) -> None:
    """Take the name away; the folder stays."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
