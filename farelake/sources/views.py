"""Named views, so that any SQL text can run over the trip data."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from farelake.sources.dimensions import payment_types, read_zones
from farelake.sources.files import find_trip_files
from farelake.sources.trips import read_union_by_name

log = logging.getLogger(__name__)


def create_views(trips: DataFrame, zones: DataFrame | None = None) -> None:
    """Register `trips`, `payment_types` and, when given, `taxi_zones`."""
    trips.createOrReplaceTempView("trips")
    payment_types(trips.sparkSession).createOrReplaceTempView("payment_types")
    if zones is not None:
        zones.createOrReplaceTempView("taxi_zones")


def register_views(
    spark: SparkSession, data_dir: str, sample_dir: str, taxi_type: str = "yellow", log_dir: str | None = None
) -> int:
    """Register the views over the monthly files and return how many files back them.

    `log_dir` is where the layouts of the files are remembered, if they are. Raises FileNotFoundError when
    neither folder has a file; a missing zone CSV is only a warning.
    """
    files = find_trip_files(spark, data_dir, sample_dir, taxi_type)
    if not files:
        raise FileNotFoundError(
            f"No parquet files of type {taxi_type!r}: looked in {data_dir}, then in {sample_dir}"
        )
    try:
        zones = read_zones(spark, f"{sample_dir}/taxi_zones.csv")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("%s holds no taxi_zones.csv, which the zone and route reports need", sample_dir)
        zones = None
        # Zones of an earlier call would belong to other data.
        spark.catalog.dropTempView("taxi_zones")
    create_views(read_union_by_name(spark, files, log_dir), zones)
    return len(files)
