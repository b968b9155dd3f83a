"""Named queries from monthly files to shown text."""

from __future__ import annotations

import pyarrow as pa
import pytest

from farelake.plans import query
from farelake.plans.reports import REPORTS
from helpers import COLUMNS, trip, write_trips


@pytest.fixture
def months(tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    drifted = {**COLUMNS, "VendorID": pa.int32(), "passenger_count": pa.int64()}
    write_trips([trip(), trip(PULocationID=-1)], data / "yellow_tripdata_2024-01.parquet")
    write_trips([trip(passenger_count=2)], data / "yellow_tripdata_2024-02.parquet", drifted)
    return str(data)


def test_all_reports(spark, months, zones_dir):
    found = query.results(spark, months, str(zones_dir))
    assert [title.split(" - ")[0] for title, _ in found] == list(REPORTS)
    assert all(frame.count() > 0 for _, frame in found)


def test_a_layout_without_the_columns_is_refused(spark, tmp_path, zones_dir):
    green = {k.replace("tpep", "lpep"): t for k, t in COLUMNS.items()}
    rows = [{**trip(), "lpep_pickup_datetime": trip()["tpep_pickup_datetime"]}]
    write_trips(rows, tmp_path / "green_tripdata_2024-01.parquet", green)
    for name in ("hourly-revenue", "duration-percentiles", "all"):
        with pytest.raises(ValueError, match="tpep_pickup_datetime"):
            query.results(spark, str(tmp_path), str(zones_dir), name, "green")
    (_, frame) = query.results(spark, str(tmp_path), str(zones_dir), "top-zones", "green")[0]
    assert frame.count() == 1


def test_unknown_name(spark, months, zones_dir):
    with pytest.raises(ValueError, match="no report"):
        query.results(spark, months, str(zones_dir), "nope")


def test_falls_back_to_the_sample(spark, tmp_path, zones_dir):
    write_trips([trip()], zones_dir / "yellow_tripdata_2024-01.parquet")
    (_, frame) = query.results(spark, str(tmp_path / "none"), str(zones_dir), "daily-trend")[0]
    assert frame.collect()[0].trips == 1


def test_shown_text(spark, months, zones_dir, monkeypatch, capsys):
    monkeypatch.setattr(query, "get_session", lambda: spark)
    query.main(["top-zones", "--data", months, "--sample", str(zones_dir), "--types", " Yellow,fhv"])
    shown = capsys.readouterr().out
    assert "top-zones - " in shown
    rows = [[c.strip() for c in line.split("|")[1:-1]] for line in shown.splitlines() if "|" in line]
    assert rows == [
        ["borough", "zone", "trip_count", "avg_fare_usd", "total_revenue_usd"],
        ["EWR", "Airport", "2", "13.0", "26.0"],
        ["-", "-", "1", "13.0", "13.0"],
    ]
