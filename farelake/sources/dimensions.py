"""The two small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake import schemas


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone CSV as (location_id, borough, zone, service_zone); `N/A` stays an ordinary string.

    `enforceSchema=False` checks the header against the declared names instead of trusting order.
    """
    reader = spark.read.schema(schemas.ZONES_CSV).option("header", True)
    return reader.option("enforceSchema", False).csv(path).select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def payment_types(spark: SparkSession) -> DataFrame:
    """Payment codes and labels, inline in the plan."""
    rows = ", ".join(f"({code}, '{label}')" for code, label in schemas.PAYMENT_LABELS)
    return spark.sql(f"VALUES {rows} AS codes(payment_type, payment_label)")
