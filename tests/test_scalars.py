from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelake.functions import (
    date_of,
    day_of_week,
    file_name,
    hour_of_day,
    interval_micros,
    longer_than,
    mean_from,
    month_start,
    round_half_away,
    seconds_between,
    split_list,
    to_int_half_even,
)
from helpers import sql_rows


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_rounding_matches_oracle_on_ties(spark, digits):
    numbers = [1.005, 17.865, 577.795, 2.675, 0.125, -2.5, -1.005, 0.05, 1e15, 2.5, float("inf")]
    numbers += [sign * i / 200 for i in range(1, 2000) for sign in (1, -1)]
    got = values(spark, [(n,) for n in numbers], "x double", round_half_away(F.col("x"), digits))
    listed = ", ".join(f"('{n!r}'::DOUBLE)" for n in numbers)
    want = sql_rows(f"SELECT round(x, {digits}) FROM (VALUES {listed}) t(x)")
    assert got == [r[0] for r in want]


def test_half_even_int(spark):
    numbers = [None, float("nan"), 0.0, 1.0, 0.5, 1.5, 2.5, -0.5, -1.5, 1e12, float("inf")]
    got = values(spark, [(n,) for n in numbers], "x double", to_int_half_even(F.col("x")))
    assert got == [None, None, 0, 1, 0, 2, 2, 0, -2, None, None]


def test_day_of_week_starts_on_sunday(spark):
    days = [(dt.datetime(2024, 1, 7) + dt.timedelta(days=i, hours=23),) for i in range(7)]
    assert values(spark, days, "t timestamp_ntz", day_of_week(F.col("t"))) == list(range(7))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_hour_and_date_match_the_calendar(spark, zone, kind):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.sql(
            "SELECT explode(sequence(timestamp_ntz'1969-12-25', timestamp_ntz'1970-01-05', "
            "INTERVAL 1777.000001 SECONDS)) AS t UNION ALL "
            "SELECT explode(sequence(timestamp_ntz'2024-03-09', timestamp_ntz'2024-03-12', "
            "INTERVAL 1777.999999 SECONDS)) UNION ALL SELECT NULL"
        ).select(F.col("t").cast(kind).alias("t"))
        plain = frame.select(
            F.hour("t").eqNullSafe(hour_of_day(F.col("t"))).alias("h"),
            F.to_date("t").eqNullSafe(date_of(F.col("t"))).alias("d"),
        )
        assert plain.where("NOT (h AND d)").count() == 0 and plain.count() > 500
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


SPANS = [
    (dt.timedelta(0), 0.0),
    (dt.timedelta(minutes=-5), -300.0),
    (dt.timedelta(microseconds=1), 1e-06),
    (dt.timedelta(hours=8, microseconds=500000), 28800.5),
    (dt.timedelta(hours=8), 28800.0),
    (dt.timedelta(hours=8, microseconds=-1), 28799.999999),
    (dt.timedelta(days=-2, microseconds=1), -172799.999999),
    (dt.timedelta(days=40000), 3456000000.0),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_seconds_ignore_session_zone(spark, zone):
    # 02:30 on this night does not exist in New York.
    start = dt.datetime(2024, 3, 10, 1, 30, 0, 750000)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(start, start + span) for span, _ in SPANS]
        seconds = seconds_between(F.col("a"), F.col("b"))
        got = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", seconds)
        micros = interval_micros(F.col("b") - F.col("a"))
        exact = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", micros)
        longer = {
            limit: values(
                spark,
                rows,
                "a timestamp_ntz, b timestamp_ntz",
                longer_than(F.col("a"), F.col("b"), limit),
            )
            for limit in (-300, 0, 28800, 28801)
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [s for _, s in SPANS]
    assert exact == [span // dt.timedelta(microseconds=1) for span, _ in SPANS]
    for limit, found in longer.items():
        assert found == [s > limit for _, s in SPANS]


def test_month_start(spark):
    texts = ["2024-01", "2023-12", "2024-1", "2023", "2023-13", "x-05", "2023.05", "2023-00", None]
    got = values(spark, [(t,) for t in texts], "m string", month_start(F.col("m")))
    jan = dt.date(2024, 1, 1)
    assert got == [jan, dt.date(2023, 12, 1), jan, None, None, None, None, None, None]


def test_file_name(spark):
    row = [("yellow", dt.date(2024, 1, 1))]
    name = file_name(F.col("t"), F.col("d"))
    assert values(spark, row, "t string, d date", name) == ["yellow_tripdata_2024-01.parquet"]


def test_split_list(spark):
    got = values(spark, [(" FHV,Green,, yellow , ",)], "s string", split_list(F.col("s")))
    assert got == [["fhv", "green", "yellow"]]


def test_mean_of_nothing_is_null(spark):
    assert values(spark, [(0.0, 0)], "s double, n bigint", mean_from(F.col("s"), F.col("n"))) == [None]
