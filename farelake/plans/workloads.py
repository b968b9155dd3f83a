"""Three small workloads used for timing."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.functions import hour_of_day, mean_from
from farelake.operators.aggregates import group_count, mean, top_by_count
from farelake.operators.exact_sums import exact_sums
from farelake.operators.topk import top_keys


def hourly_trip_count(trips: DataFrame, keep_missing: bool = True) -> DataFrame:
    """Trips by hour of pickup."""
    hour = hour_of_day(F.col("tpep_pickup_datetime"))
    return group_count(trips, hour, "hour", keep_missing).orderBy(F.asc_nulls_last("hour"))


def top10_pickup_zones(trips: DataFrame, keep_missing: bool = True, many_ids: bool = False) -> DataFrame:
    """Ten busiest pickup ids (ids, not names).

    With `many_ids`, far more than a task's counts should move, only those are counted that can win.
    """
    if many_ids:
        return top_keys(trips, F.col("PULocationID"), "PULocationID", 10, keep_missing)
    counted = group_count(trips, F.col("PULocationID"), "PULocationID", keep_missing)
    return top_by_count(counted, "n", ["PULocationID"], 10)


def filter_long_trips_avg_fare(trips: DataFrame, skip_nan: bool = False, exact: bool = False) -> DataFrame:
    """Mean fare of trips over five miles, unrounded.

    `exact` adds up without rounding, so the last digits do not depend on how the trips are dealt to tasks.
    """
    long_trips = trips.where(F.col("trip_distance") > 5)
    if exact:
        fare = F.when(~F.isnan("fare_amount"), F.col("fare_amount")) if skip_nan else F.col("fare_amount")
        summed = exact_sums(long_trips, [], {"fare": fare})
        return summed.select(F.try_divide("fare", "fare_n").alias("avg_fare"))
    return long_trips.agg(mean(F.col("fare_amount"), skip_nan).alias("avg_fare"))


def _hourly_from_time(parts: DataFrame) -> DataFrame:
    per_hour = parts.groupBy(F.col("hour_of_day").alias("hour")).agg(F.sum("trips").alias("n"))
    return per_hour.orderBy(F.asc_nulls_last("hour"))


def _top10_from_place(parts: DataFrame) -> DataFrame:
    per_id = parts.groupBy("PULocationID").agg(F.sum("trips").alias("n"))
    return top_by_count(per_id, "n", ["PULocationID"], 10)


def _long_fare_from_payment(parts: DataFrame) -> DataFrame:
    total, count = F.sum("long_fare_amount_sum"), F.sum("long_fare_amount_n")
    return parts.agg(mean_from(total, count).alias("avg_fare"))


@dataclass(frozen=True)
class Workload:
    """A timing workload, the trip columns it reads, and the rollup it can be finished from."""

    name: str
    description: str
    build: Callable[[DataFrame], DataFrame]
    reads: tuple[str, ...]
    rollup: str | None = None
    finish: Callable[[DataFrame], DataFrame] | None = None

    def over(self, trips: DataFrame, rollups: Mapping[str, DataFrame] | None = None) -> DataFrame:
        if rollups and self.rollup in rollups:
            return self.finish(rollups[self.rollup])
        return self.build(trips)


# Workload names and output columns are the interface users call.
WORKLOADS: dict[str, Workload] = {
    workload.name: workload
    for workload in (
        Workload(
            "hourly_trip_count",
            "Trips per hour of day",
            hourly_trip_count,
            ("tpep_pickup_datetime",),
            rollup="time",
            finish=_hourly_from_time,
        ),
        Workload(
            "top10_pickup_zones",
            "Ten busiest pickup ids",
            top10_pickup_zones,
            ("PULocationID",),
            rollup="place",
            finish=_top10_from_place,
        ),
        Workload(
            "filter_long_trips_avg_fare",
            "Mean fare beyond five miles",
            filter_long_trips_avg_fare,
            ("trip_distance", "fare_amount"),
            rollup="payment",
            finish=_long_fare_from_payment,
        ),
    )
}
