"""Spark session with the settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every Column call takes longer than planning the report.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    app_name: str = "farelake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Return a session. On a cluster leave `master` unset and let spark-submit choose it.

    `shuffle_partitions` is the upper bound AQE coalesces from; size it so that one partition of the
    largest shuffle stays near 128 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
