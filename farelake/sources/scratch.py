"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`.

    Only a local session may go without one and gets a folder of its own; on a cluster a local folder
    would be another one on every machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="farelake-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, safe from lost executors."""
    path = new_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Spark's switches for removing the shuffle files of a query as soon as it ends.
CLEANUP = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.shuffleDependency.fileCleanup.enabled")


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within this block, shuffle files go when the query that wrote them ends: a stored result needs them no more."""
    before = {name: spark.conf.get(name, None) for name in CLEANUP}
    for name in CLEANUP:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
