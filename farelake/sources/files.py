"""File listings through Spark's own file index, so any Hadoop file system works."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MONTH_PATH = r"^(.*/[a-z]+_tripdata_\d{4}-\d{2}[^/]*)"


def list_files(spark: SparkSession, *patterns: str) -> DataFrame:
    """(path, length) of every file under the globs; no rows when nothing matches.

    Only the listing is read: the content column of the binary source is pruned away.
    """
    try:
        return spark.read.format("binaryFile").load(list(patterns)).select("path", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(
            F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("length")
        )


def find_trip_files(
    spark: SparkSession, data_dir: str, sample_dir: str, taxi_type: str = "yellow"
) -> list[str]:
    """Sorted months of one taxi type in `data_dir`, else in `sample_dir`, else none.

    A month is a file or a folder of part files; the driver gets one path per month, not per part.
    """
    for folder in (data_dir, sample_dir):
        listing = list_files(spark, f"{folder}/{taxi_type}_tripdata_*.parquet")
        months = listing.select(F.regexp_extract("path", _MONTH_PATH, 1).alias("path")).distinct()
        paths = sorted(row.path for row in months.collect() if row.path)
        if paths:
            return paths
    return []
