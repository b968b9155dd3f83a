"""The physical plans behind the reports: what is read, pushed down, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest

from conftest import SMALL
from checks.registry import QUERIES
from farelake.plans.reports import REPORTS, ROLLUPS
from farelake.plans.workloads import WORKLOADS
from farelake.sources.dimensions import read_zones
from farelake.sources.tables import load, save
from helpers import trip, write_trips


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    path = write_trips([trip()] * 20, tmp_path_factory.mktemp("plans") / "t.parquet")
    return spark.read.parquet(path)


@pytest.fixture
def zones(spark, zones_dir):
    return read_zones(spark, f"{zones_dir}/taxi_zones.csv")


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_reads_only_its_columns(trips, zones, name):
    report = REPORTS[name]
    plan = plan_text(report.over(trips, zones))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    read = {
        column
        for scan in scans
        for column in re.findall(r"(\w+):", scan.split("ReadSchema: struct<")[1])
    }
    assert read == set(report.reads)


PUSHED = {
    "top-zones": "GreaterThan(total_amount,0.0)",
    "hourly-revenue": "GreaterThan(total_amount,0.0)",
    "tip-patterns": "GreaterThan(fare_amount,0.0)",
    "fare-per-mile": "GreaterThan(trip_distance,0.1)",
    "weekend-vs-weekday": "GreaterThan(total_amount,0.0)",
    "daily-trend": "GreaterThan(total_amount,0.0)",
}


@pytest.mark.parametrize("name", list(PUSHED))
def test_filters_reach_the_scan(trips, zones, name):
    assert PUSHED[name] in plan_text(REPORTS[name].over(trips, zones)).replace("...", "")


def test_every_plan_stays_in_the_engine(trips, zones):
    frames = [r.over(trips, zones) for r in REPORTS.values()]
    frames += [w.build(trips) for w in WORKLOADS.values()]
    for frame in frames:
        plan = plan_text(frame)
        for costly in ("Python", "NestedLoop", "Cartesian", "ObjectHashAggregate(keys=[v"):
            assert costly not in plan


def test_top_k_is_not_a_sort(trips, zones):
    for name in ("top-zones", "top-routes"):
        plan = plan_text(REPORTS[name].over(trips, zones))
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_facts_shrink_before_they_meet_a_dimension(trips, zones):
    for name in ("top-zones", "top-routes", "tip-patterns"):
        lines = plan_text(REPORTS[name].over(trips, zones)).splitlines()
        join = max(i for i, line in enumerate(lines) if "HashJoin" in line)
        partial = [i for i, line in enumerate(lines) if "partial_count(1)" in line]
        assert partial and min(partial) > join


def test_flags_need_one_scan(trips):
    assert plan_text(REPORTS["fraud-heuristics"].over(trips)).count("FileScan parquet") == 1


def scans(frame):
    """Scans of the facts that ran, an exchange that is read again counted once."""
    frame.collect()
    return plan_text(frame).split("Initial Plan")[0].count("FileScan parquet")


def test_percentiles_scan_the_facts_twice(trips):
    assert scans(REPORTS["duration-percentiles"].over(trips)) <= 3


def test_share_needs_one_scan(trips):
    assert scans(REPORTS["passenger-distribution"].over(trips.where("trip_distance > 1"))) == 1


def test_batch_scans_the_facts_five_times(spark, trips, zones, tmp_path):
    facts = trips.where("trip_distance > 1")
    total, rollups = 0, {}
    for name, build in ROLLUPS.items():
        total += scans(build(facts))
        save(build(facts), f"{tmp_path}/{name}")
        rollups[name] = load(spark, f"{tmp_path}/{name}")
    for report in REPORTS.values():
        if report.rollup is None:
            total += 2
            assert report.name == "duration-percentiles"
    assert total <= 5 and all(w.rollup in rollups for w in WORKLOADS.values())


def test_percentiles_shuffle_buckets_not_trips(spark):
    """With a different length for nearly every trip, only counts per second and two buckets move."""
    start = "timestamp_ntz'2024-01-01 00:00:00'"
    length = "make_dt_interval(0, 0, 0, CAST(1 + (id * 7919) % 20000 + (id % 999983) / 1e6 AS decimal(18, 6)))"
    frame = spark.range(0, 200_000, 1, 4).selectExpr(
        f"{start} AS tpep_pickup_datetime", f"{start} + {length} AS tpep_dropoff_datetime"
    )
    report = REPORTS["duration-percentiles"].over(frame)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        if node.nodeName() == "Exchange" and node.metrics().contains("shuffleRecordsWritten"):
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(plan)
    # Four tasks hold at most 20,000 seconds each, whatever the number of trips.
    assert written and max(written) <= 4 * 20_001


def test_order_dates_are_joined_only_for_times(spark):
    assert "o_orderdate" not in plan_text(QUERIES["q01_top_zones"](spark, SMALL))
    assert "o_orderdate" in plan_text(QUERIES["q02_hourly_revenue"](spark, SMALL))


def test_growing_sides_are_not_forced_to_broadcast(spark):
    """With the size check switched off, only sides bounded in the code are still broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, query in QUERIES.items():
            plan = plan_text(query(spark, SMALL))
            for side in re.findall(r"BroadcastExchange.*\n(.*(?:\n.*){0,3})", plan):
                assert "LocalTableScan" in side or "Window" in side or "before" in side, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
