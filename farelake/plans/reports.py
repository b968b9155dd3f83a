"""The ten named reports. Each is a lazy DataFrame over `trips` and the dimensions it needs.

Reports that only add up work in two steps: `*_parts` reduces the trips to sums and counts per key
(never means), and a finishing step merges those parts. So

- a key that holds a third of all trips costs one row per task, as partial aggregation runs before
  the shuffle, and dimensions are joined to parts, never to trips;
- a batch of reports can share parts: the rollups at the end hold them by time and by place, so eight
  results need two scans.

No join side is forced to be broadcast unless its size is fixed in the code; for the others Spark
compares file or shuffle sizes with its broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.functions import (
    date_of,
    day_of_week,
    hour_of_day,
    interval_micros,
    longer_than,
    mean_from,
    round_half_away,
    to_int_half_even,
)
from farelake.operators.aggregates import count_flags, share_of_total, top_by_count
from farelake.operators.quantiles import exact_quantiles, histogram
from farelake.sources.dimensions import payment_types

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
MICROS_PER_SECOND = 1_000_000

# Trips that count for revenue, and trips that have a price per mile.
PAID = "total_amount > 0"
RATED = "trip_distance > 0.1D AND fare_amount > 0"
PRICED = "fare_amount > 0"
LONG = "trip_distance > 5"
TIPS = {"tip": "tip_amount", "pct": "100D * tip_amount / nullif(fare_amount, 0D)"}
RATES = {"per_mile": "fare_amount / nullif(trip_distance, 0D)", "distance": "trip_distance"}


def _rows() -> Column:
    return F.count(F.lit(1))


def _sums(measures: Mapping[str, str], prefix: str = "", when: str | None = None) -> list[Column]:
    """Row count, and sum and count per measure, over the rows where `when` holds."""

    def over(sql: str) -> str:
        return f"CASE WHEN {when} THEN {sql} END" if when else sql

    columns = [F.expr(f"count({over('1')})").alias(f"{prefix}trips")]
    for name, sql in measures.items():
        columns.append(F.expr(f"sum({over(sql)})").alias(f"{prefix}{name}_sum"))
        columns.append(F.expr(f"count({over(sql)})").alias(f"{prefix}{name}_n"))
    return columns


def _merged(prefix: str, measures: Mapping[str, str]) -> list[Column]:
    """The same parts, summed up once more."""
    names = [f"{prefix}trips", *[f"{prefix}{name}_{end}" for name in measures for end in ("sum", "n")]]
    return [F.sum(name).alias(name) for name in names]


def _mean(measure: str, digits: int = 2) -> Column:
    """Mean of a measure over merged parts."""
    return round_half_away(mean_from(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n")), digits)


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _paid_parts(trips: DataFrame, key: Column, *measures: str) -> DataFrame:
    return trips.where(PAID).groupBy(key).agg(*_sums(_same(*measures), "paid_"))


def _hour() -> Column:
    return hour_of_day(F.col(PICKUP)).alias("hour_of_day")


def _date() -> Column:
    return date_of(F.col(PICKUP)).alias("pickup_date")


def top_zones(trips: DataFrame, zones: DataFrame, limit: int = 10) -> DataFrame:
    """Busiest pickup zones by name; ids without a zone share one (null, null) group."""
    return _top_zones(_paid_parts(trips, F.col("PULocationID"), "total_amount"), zones, limit)


def _top_zones(parts: DataFrame, zones: DataFrame, limit: int = 10) -> DataFrame:
    paid = parts.where("paid_trips > 0")
    per_name = (
        paid.join(zones, paid.PULocationID == zones.location_id, "left")
        .groupBy("borough", "zone")
        .agg(
            F.sum("paid_trips").alias("trip_count"),
            _mean("paid_total_amount").alias("avg_fare_usd"),
            round_half_away(F.sum("paid_total_amount_sum")).alias("total_revenue_usd"),
        )
    )
    return top_by_count(per_name, "trip_count", ["borough", "zone"], limit)


def hourly_revenue(trips: DataFrame) -> DataFrame:
    """Trips and revenue by hour of pickup; hours without trips are left out."""
    return _hourly_revenue(_paid_parts(trips, _hour(), "total_amount"))


def _hourly_revenue(parts: DataFrame) -> DataFrame:
    return (
        parts.where("paid_trips > 0")
        .groupBy("hour_of_day")
        .agg(
            F.sum("paid_trips").alias("trips"),
            round_half_away(F.sum("paid_total_amount_sum")).alias("revenue_usd"),
            _mean("paid_total_amount").alias("avg_fare_usd"),
        )
        .orderBy(F.asc_nulls_last("hour_of_day"))
    )


def tip_patterns(trips: DataFrame, payments: DataFrame | None = None) -> DataFrame:
    """Tips by payment label; codes without a label share the null group.

    The percentage is the mean of per-trip percentages, not a ratio of sums.
    """
    per_code = trips.where(PRICED).groupBy("payment_type").agg(*_sums(TIPS, "tipped_"))
    return _tip_patterns(per_code, payments)


def _tip_patterns(parts: DataFrame, payments: DataFrame | None = None) -> DataFrame:
    if payments is None:
        payments = F.broadcast(payment_types(parts.sparkSession))  # six rows, fixed in the code
    per_code = parts.groupBy("payment_type").agg(*_merged("tipped_", TIPS)).where("tipped_trips > 0")
    return (
        per_code.join(payments, "payment_type", "left")
        .groupBy("payment_label")
        .agg(
            F.sum("tipped_trips").alias("trip_count"),
            _mean("tipped_tip").alias("avg_tip_usd"),
            _mean("tipped_pct").alias("avg_tip_pct"),
        )
        .orderBy(F.desc("trip_count"), F.asc_nulls_last("payment_label"))
    )


def _lengths(trips: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Trips of up to six hours, the second of their length, and the length in microseconds."""
    length = interval_micros(F.col(DROPOFF) - F.col(PICKUP))
    too_long = longer_than(F.col(PICKUP), F.col(DROPOFF), 360 * 60)
    plausible = trips.where((F.col(DROPOFF) > F.col(PICKUP)) & ~too_long)
    return plausible, F.floor(length / MICROS_PER_SECOND), length


def length_histogram(trips: DataFrame, *keys: Column) -> DataFrame:
    """Trips of up to six hours per second of length, and their minutes; at most 21,601 rows per key."""
    plausible, second, length = _lengths(trips)
    return histogram(plausible, second, length, unit=60.0 * MICROS_PER_SECOND, keys=keys)


def duration_percentiles(trips: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """Exact, interpolated duration percentiles in minutes over trips of up to six hours.

    Six hours are 21,601 buckets of a second. The trips are scanned twice, two columns each time; once
    where `lengths` gives the histograms of all their months.
    """
    plausible, second, length = _lengths(trips)
    percentiles = {"p50_min": 0.50, "p75_min": 0.75, "p90_min": 0.90, "p99_min": 0.99}
    found = exact_quantiles(
        plausible,
        bucket=second,
        value=length,
        quantiles=percentiles,
        max_buckets=21_601,
        unit=60.0 * MICROS_PER_SECOND,
        known=lengths,
    )
    return found.select(
        *[round_half_away(F.col(name), 1).alias(name) for name in percentiles],
        round_half_away(F.col("mean"), 1).alias("avg_min"),
        F.col("rows").alias("trip_count"),
    )


def fare_per_mile(trips: DataFrame) -> DataFrame:
    """Mean of per-trip dollars per mile, by hour of pickup."""
    return _fare_per_mile(trips.where(RATED).groupBy(_hour()).agg(*_sums(RATES, "rated_")))


def _fare_per_mile(parts: DataFrame) -> DataFrame:
    return (
        parts.where("rated_trips > 0")
        .groupBy("hour_of_day")
        .agg(
            _mean("rated_per_mile").alias("usd_per_mile"),
            _mean("rated_distance").alias("avg_distance_mi"),
        )
        .orderBy(F.asc_nulls_last("hour_of_day"))
    )


def weekend_vs_weekday(trips: DataFrame) -> DataFrame:
    """Weekday against weekend (Saturday and Sunday); a missing pickup counts as weekday."""
    measures = ("total_amount", "tip_amount", "trip_distance")
    return _weekend_vs_weekday(_paid_parts(trips, _date(), *measures))


def _weekend_vs_weekday(parts: DataFrame) -> DataFrame:
    weekend = day_of_week(F.col("pickup_date")).isin(0, 6)
    return (
        parts.where("paid_trips > 0")
        .groupBy(F.when(weekend, "weekend").otherwise("weekday").alias("day_type"))
        .agg(
            F.sum("paid_trips").alias("trips"),
            _mean("paid_total_amount").alias("avg_fare_usd"),
            _mean("paid_tip_amount").alias("avg_tip_usd"),
            _mean("paid_trip_distance").alias("avg_distance_mi"),
        )
        .orderBy("day_type")
    )


def _flags() -> dict[str, Column]:
    fare, distance, tip = F.col("fare_amount"), F.col("trip_distance"), F.col("tip_amount")
    return {
        "negative_fare": fare < 0,
        "distance_over_100mi": distance > 100,
        "duration_over_6h": longer_than(F.col(PICKUP), F.col(DROPOFF), 6 * 3600),
        "pickup_after_dropoff": F.col(DROPOFF) < F.col(PICKUP),
        "zero_distance_with_fare": (distance == 0) & (fare > 5),
        "tip_over_50pct": (fare > 0) & (F.try_divide(tip, fare) > 0.5),
    }


def fraud_heuristics(trips: DataFrame) -> DataFrame:
    """Hits of six overlapping flags, counted in one scan; always six rows."""
    return count_flags(trips, _flags()).orderBy(F.desc("hits"), "flag")


def _fraud_heuristics(parts: DataFrame) -> DataFrame:
    names = list(_flags())
    summed = parts.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names])
    return summed.unpivot([], names, "flag", "hits").orderBy(F.desc("hits"), "flag")


def top_routes(trips: DataFrame, zones: DataFrame, limit: int = 10) -> DataFrame:
    """Busiest (pickup zone, dropoff zone) pairs by name; both zones must be known."""
    measures = _same("total_amount", "trip_distance")
    per_pair = trips.groupBy("PULocationID", "DOLocationID").agg(*_sums(measures))
    return _top_routes(per_pair, zones, limit)


def _top_routes(parts: DataFrame, zones: DataFrame, limit: int = 10) -> DataFrame:
    known = zones.where(F.col("zone").isNotNull())
    pickups = known.selectExpr("location_id AS PULocationID", "zone AS pickup_zone")
    dropoffs = known.selectExpr("location_id AS DOLocationID", "zone AS dropoff_zone")
    per_route = (
        parts.join(pickups, "PULocationID")
        .join(dropoffs, "DOLocationID")
        .groupBy("pickup_zone", "dropoff_zone")
        .agg(
            F.sum("trips").alias("trip_count"),
            _mean("total_amount").alias("avg_fare_usd"),
            _mean("trip_distance").alias("avg_distance_mi"),
        )
    )
    return top_by_count(per_route, "trip_count", ["pickup_zone", "dropoff_zone"], limit)


def daily_trend(trips: DataFrame) -> DataFrame:
    """Trips and revenue by calendar date of pickup; dates without trips are left out."""
    return _daily_trend(_paid_parts(trips, _date(), "total_amount"))


def _daily_trend(parts: DataFrame) -> DataFrame:
    return (
        parts.where("paid_trips > 0")
        .groupBy("pickup_date")
        .agg(
            F.sum("paid_trips").alias("trips"),
            round_half_away(F.sum("paid_total_amount_sum")).alias("revenue_usd"),
        )
        .orderBy(F.asc_nulls_last("pickup_date"))
    )


def _passenger_parts(trips: DataFrame) -> DataFrame:
    # Grouped as stored first: the checked cast is dear, and then runs per value, not per trip.
    return trips.groupBy("passenger_count").agg(*_sums(_same("total_amount")))


def _passenger_distribution(parts: DataFrame) -> DataFrame:
    passengers = F.coalesce(to_int_half_even(F.col("passenger_count")), F.lit(0))
    counted = parts.groupBy(passengers.alias("passengers")).agg(
        F.sum("trips").alias("trips"), _mean("total_amount").alias("avg_fare_usd")
    )
    # One row per passenger count reaches the window, so the total is that of the very same rows.
    total = F.sum("trips").over(Window.partitionBy())
    return counted.select(
        "passengers",
        "trips",
        round_half_away(share_of_total(counted, "trips", total), 2).alias("pct_of_total"),
        "avg_fare_usd",
    ).orderBy("passengers")


def _passenger_distribution_of(parts: DataFrame) -> DataFrame:
    names = ["trips", "total_amount_sum", "total_amount_n"]
    per_count = parts.groupBy("passenger_count").agg(*[F.sum(name).alias(name) for name in names])
    return _passenger_distribution(per_count)


def passenger_distribution(trips: DataFrame) -> DataFrame:
    """Trips by passenger count with their share; missing counts are pooled with zero."""
    return _passenger_distribution(_passenger_parts(trips))


def time_rollup(trips: DataFrame, *keys: Column) -> DataFrame:
    """Parts per calendar date and hour of pickup, for every report keyed by time.

    Further `keys` of a rollup tell the parts of several months apart; whatever is finished from them adds
    them up.
    """
    measures = _same("total_amount", "tip_amount", "trip_distance")
    return trips.groupBy(*keys, _date(), _hour()).agg(
        _rows().alias("trips"), *_sums(measures, "paid_", PAID), *_sums(RATES, "rated_", RATED)
    )


def place_rollup(trips: DataFrame, *keys: Column) -> DataFrame:
    """Parts per pickup and dropoff id, for every report keyed by place."""
    return trips.groupBy(*keys, "PULocationID", "DOLocationID").agg(
        *_sums(_same("total_amount", "trip_distance")),
        *_sums(_same("total_amount"), "paid_", PAID),
    )


def payment_rollup(trips: DataFrame, *keys: Column) -> DataFrame:
    """Parts per payment type and passenger count, for the reports and the workload keyed by neither."""
    return trips.groupBy(*keys, "payment_type", "passenger_count").agg(
        *_sums(_same("total_amount")),
        *_sums(TIPS, "tipped_", PRICED),
        *_sums(_same("fare_amount"), "long_", LONG),
        *[F.count_if(condition).alias(flag) for flag, condition in _flags().items()],
    )


ROLLUPS = {"time": time_rollup, "place": place_rollup, "payment": payment_rollup}

#: What a load keeps of every month: all reports are finished from these, added up over the months, but
#: that the percentiles look once more at the trips of a few lengths.
MONTHLY = {**ROLLUPS, "lengths": length_histogram}


@dataclass(frozen=True)
class Report:
    """A named report and the trip columns it reads.

    With `rollup` set, `finish` gives the same result from that rollup instead of the trips. `spares`
    names a rollup that spares `build` one of its scans.
    """

    name: str
    description: str
    build: Callable[..., DataFrame]
    reads: tuple[str, ...]
    with_zones: bool = False
    rollup: str | None = None
    finish: Callable[..., DataFrame] | None = None
    spares: str | None = None

    def over(
        self,
        trips: DataFrame,
        zones: DataFrame | None = None,
        rollups: Mapping[str, DataFrame] | None = None,
    ) -> DataFrame:
        rest = (zones,) if self.with_zones else ()
        if rollups and self.rollup in rollups:
            return self.finish(rollups[self.rollup], *rest)
        if rollups and self.spares in rollups:
            return self.build(trips, *rest, rollups[self.spares])
        return self.build(trips, *rest)


# Report names, flag names and output columns are the interface users call.
REPORTS: dict[str, Report] = {
    report.name: report
    for report in (
        Report(
            "top-zones",
            "Busiest pickup zones and their revenue",
            top_zones,
            ("PULocationID", "total_amount"),
            with_zones=True,
            rollup="place",
            finish=_top_zones,
        ),
        Report(
            "hourly-revenue",
            "Trips and revenue per hour of day",
            hourly_revenue,
            (PICKUP, "total_amount"),
            rollup="time",
            finish=_hourly_revenue,
        ),
        Report(
            "tip-patterns",
            "Tips per payment method",
            tip_patterns,
            ("payment_type", "fare_amount", "tip_amount"),
            rollup="payment",
            finish=_tip_patterns,
        ),
        Report(
            "duration-percentiles",
            "Percentiles of trip length in minutes",
            duration_percentiles,
            (PICKUP, DROPOFF),
            spares="lengths",
        ),
        Report(
            "fare-per-mile",
            "Dollars per mile, per hour of day",
            fare_per_mile,
            (PICKUP, "trip_distance", "fare_amount"),
            rollup="time",
            finish=_fare_per_mile,
        ),
        Report(
            "weekend-vs-weekday",
            "Weekdays against weekends",
            weekend_vs_weekday,
            (PICKUP, "total_amount", "tip_amount", "trip_distance"),
            rollup="time",
            finish=_weekend_vs_weekday,
        ),
        Report(
            "fraud-heuristics",
            "Counts of suspicious trips",
            fraud_heuristics,
            (PICKUP, DROPOFF, "fare_amount", "trip_distance", "tip_amount"),
            rollup="payment",
            finish=_fraud_heuristics,
        ),
        Report(
            "top-routes",
            "Busiest zone-to-zone routes",
            top_routes,
            ("PULocationID", "DOLocationID", "total_amount", "trip_distance"),
            with_zones=True,
            rollup="place",
            finish=_top_routes,
        ),
        Report(
            "daily-trend",
            "Trips and revenue per day",
            daily_trend,
            (PICKUP, "total_amount"),
            rollup="time",
            finish=_daily_trend,
        ),
        Report(
            "passenger-distribution",
            "Share of trips per passenger count",
            passenger_distribution,
            ("passenger_count", "total_amount"),
            rollup="payment",
            finish=_passenger_distribution_of,
        ),
    )
}


def run_all(
    trips: DataFrame, zones: DataFrame, rollups: Mapping[str, DataFrame] | None = None
) -> Iterator[tuple[Report, DataFrame]]:
    """Every report in order, with default parameters. Frames are lazy; the caller acts on them.

    Pass saved `rollups` to spare a scan of the trips per report that can be finished from them.
    """
    for report in REPORTS.values():
        yield report, report.over(trips, zones, rollups)
