"""The ten reports and three workloads over hand-written edge rows, against plain SQL."""

from __future__ import annotations

import datetime as dt

import pytest

from checks.oracles import PAYMENTS, REPORT_NAMES, RIDES
from checks.oracles import REPORTS as SQL
from farelake.plans.reports import REPORTS, ROLLUPS, run_all, top_routes, top_zones
from farelake.plans.workloads import (
    WORKLOADS,
    filter_long_trips_avg_fare,
    hourly_trip_count,
    top10_pickup_zones,
)
from farelake.sources.dimensions import read_zones
from farelake.sources.tables import load, save
from helpers import NOON, same, sql_rows, trip, write_trips

ORDER = {
    "q02_hourly_revenue": "hour_of_day NULLS LAST",
    "q03_tip_patterns": "trip_count DESC, payment_label NULLS LAST",
    "q05_fare_per_mile": "hour_of_day NULLS LAST",
    "q06_weekend_vs_weekday": "day_type",
    "q07_fraud_heuristics": "hits DESC, flag",
    "q09_daily_trend": "pickup_date NULLS LAST",
    "q10_passenger_distribution": "passengers",
}


def after(**span):
    return {"tpep_dropoff_datetime": NOON + dt.timedelta(**span)}


EDGE = [
    *[trip(passenger_count=p) for p in (None, float("nan"), 0.0, 1.0, 0.5, 1.5, 2.5, 1e12)],
    *[
        trip(**after(**span))
        for span in (
            {"seconds": 0},
            {"minutes": -5},
            {"seconds": 30},
            {"minutes": 360},
            {"minutes": 360, "microseconds": 1},
            {"hours": 8},
            {"hours": 13},
            {"seconds": 61, "microseconds": 250001},
        )
    ],
    *[trip(tpep_pickup_datetime=dt.datetime(2024, 1, day, day)) for day in range(7, 14)],
    trip(tpep_pickup_datetime=None),
    trip(tpep_dropoff_datetime=None),
    *[trip(PULocationID=i) for i in (-1, None, 56, 57, 264, 265)],
    *[trip(DOLocationID=i, total_amount=None) for i in (-1, None, 56, 57, 264)],
    *[trip(payment_type=p) for p in (0, 7, None, 2, 6)],
    trip(fare_amount=0.0, tip_amount=5.0),
    trip(trip_distance=0.0),
    trip(trip_distance=0.1),
    trip(trip_distance=float("nan")),
    trip(fare_amount=None, total_amount=-3.0),
    trip(fare_amount=-10.0, trip_distance=150.0, **after(hours=9)),
    trip(trip_distance=0.0, fare_amount=6.0, tip_amount=4.0),
    trip(total_amount=1.005, fare_amount=17.865, trip_distance=8.0, PULocationID=264),
]


@pytest.fixture
def data(spark, tmp_path, zones_dir):
    def over(rows):
        path = write_trips(rows, tmp_path / "trips.parquet")
        csv = f"{zones_dir}/taxi_zones.csv"
        tables = {
            "trips": f"read_parquet('{path}')",
            "zones_file": f"read_csv('{csv}', header=true, all_varchar=false)",
        }
        return spark.read.parquet(path), read_zones(spark, csv), tables

    return over


ZONES = """taxi_zones AS (
    SELECT LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone FROM zones_file
)"""


@pytest.mark.parametrize("rows", [EDGE, []], ids=["edge", "empty"])
@pytest.mark.parametrize("key", list(SQL))
def test_report_matches_sql(data, key, rows):
    trips, zones, tables = data(rows)
    report = REPORTS[REPORT_NAMES[key]]
    got = [tuple(r) for r in report.over(trips, zones).collect()]
    sql = f"WITH {ZONES}, {PAYMENTS}, {RIDES} SELECT * FROM ({SQL[key]})"
    if key in ORDER:
        sql += f" ORDER BY {ORDER[key]}"
    assert same(got, sql_rows(sql, **tables))


def test_zone_names_merge_but_ids_do_not(data):
    trips, zones, _ = data([trip(PULocationID=56), trip(PULocationID=57), trip(PULocationID=57)])
    assert [tuple(r)[:3] for r in top_zones(trips, zones).collect()] == [("Queens", "Corona", 3)]
    assert [tuple(r) for r in top10_pickup_zones(trips).collect()] == [(57, 2), (56, 1)]


@pytest.mark.parametrize("rows", [EDGE, []], ids=["edge", "empty"])
def test_rollups_give_the_same_results(data, spark, tmp_path, rows):
    trips, zones, _ = data(rows)
    rollups = {}
    for name, build in ROLLUPS.items():
        save(build(trips), f"{tmp_path}/{name}")
        rollups[name] = load(spark, f"{tmp_path}/{name}")
    shared = 0
    for report in REPORTS.values():
        direct, finished = report.over(trips, zones), report.over(trips, zones, rollups)
        assert finished.schema.simpleString() == direct.schema.simpleString()
        assert same(finished.collect(), direct.collect())
        shared += report.rollup in rollups
    for workload in WORKLOADS.values():
        assert same(workload.over(trips, rollups).collect(), workload.build(trips).collect())
        shared += workload.rollup in rollups
    assert shared == len(REPORTS) - 1 + len(WORKLOADS)


def test_limits(data):
    trips, zones, _ = data([trip(PULocationID=i, DOLocationID=i) for i in (1, 1, 2, 56, 264)])
    assert [r.trip_count for r in top_zones(trips, zones, limit=2).collect()] == [2, 1]
    assert top_routes(trips, zones, limit=3).count() == 3


def test_duplicate_zone_rows_multiply_like_a_join(data, spark):
    trips, zones, _ = data([trip(PULocationID=1), trip(PULocationID=2)])
    doubled = zones.unionAll(zones.where("location_id = 1"))
    found = {r.zone: r.trip_count for r in top_zones(trips, doubled).collect()}
    assert found == {"Airport": 2, "Bay": 1}


def test_unknown_dropoff_is_left_out(data):
    trips, zones, _ = data([trip(DOLocationID=-1), trip(DOLocationID=2)])
    assert [tuple(r)[:3] for r in top_routes(trips, zones).collect()] == [("Airport", "Bay", 1)]


def test_properties(data):
    trips, zones, _ = data(EDGE)
    frames = {report.name: frame.collect() for report, frame in run_all(trips, zones)}
    assert list(frames) == list(REPORTS) and len(frames) == 10
    assert all(0 <= r.hour_of_day <= 23 for r in frames["hourly-revenue"] if r.hour_of_day is not None)
    p = frames["duration-percentiles"][0]
    assert p.p50_min <= p.p75_min <= p.p90_min <= p.p99_min
    assert sum(r.pct_of_total for r in frames["passenger-distribution"]) == pytest.approx(100, abs=0.5)
    assert {r.day_type for r in frames["weekend-vs-weekday"]} == {"weekday", "weekend"}


def test_workload_variants(data):
    rows = [
        trip(tpep_pickup_datetime=None),
        trip(PULocationID=None, trip_distance=9.0, fare_amount=float("nan")),
        trip(trip_distance=9.0, fare_amount=4.0),
        trip(trip_distance=5.0, fare_amount=400.0),
    ]
    trips, _, _ = data(rows)
    assert [tuple(r) for r in hourly_trip_count(trips).collect()] == [(12, 3), (None, 1)]
    assert [tuple(r) for r in hourly_trip_count(trips, keep_missing=False).collect()] == [(12, 3)]
    assert [tuple(r) for r in top10_pickup_zones(trips).collect()] == [(1, 3), (None, 1)]
    assert [tuple(r) for r in top10_pickup_zones(trips, keep_missing=False).collect()] == [(1, 3)]
    spread = filter_long_trips_avg_fare(trips).collect()[0].avg_fare
    assert spread != spread
    assert filter_long_trips_avg_fare(trips, skip_nan=True).collect()[0].avg_fare == 4.0
    assert len(WORKLOADS) == 3
