"""Months appear together or not at all, whatever ends a load; a load reads and reduces its own months only."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest

from farelake.plans import ingest, job
from farelake.plans.ingest import read_rollups, read_table, run_load
from farelake.plans.reports import MONTHLY, REPORTS
from farelake.plans.workloads import WORKLOADS
from farelake.sources import versions
from farelake.sources.dimensions import read_zones
from farelake.sources.scratch import shared_folder
from helpers import NOON, same, trip, write_trips


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder


def write(folder, month, rows):
    write_trips([trip(total_amount=float(i)) for i in range(rows)], folder / f"yellow_tripdata_{month}.parquet")


def counts(spark, table, version=None):
    found = read_table(spark, table, version).groupBy("month").count().collect()
    return {r.month: r["count"] for r in found}


def load(spark, source, table, last="2024-03"):
    return run_load(spark, str(source), str(table), ["yellow"], "2024-01", last)


class Killed(BaseException):
    """Ends a load as a kill does: nothing catches it."""


def test_months_and_an_empty_one_appear_at_once(spark, tmp_path, source, monkeypatch):
    table = str(tmp_path / "trips")
    for month, rows in (("2024-01", 4), ("2024-02", 5)):
        write(source, month, rows)
    load(spark, source, table, "2024-02")
    for month, rows in (("2024-01", 0), ("2024-02", 7), ("2024-03", 9)):
        write(source, month, rows)
    seen = []
    plain = versions.Store.rename

    def watched(self, old, new):
        seen.append(counts(spark, table))
        done = plain(self, old, new)
        seen.append(counts(spark, table))
        return done

    monkeypatch.setattr(versions.Store, "rename", watched)
    load(spark, source, table)
    assert seen == [{"2024-01": 4, "2024-02": 5}, {"2024-02": 7, "2024-03": 9}]
    assert versions.versions(spark, table) == [1, 2]
    assert counts(spark, table, 1) == {"2024-01": 4, "2024-02": 5}
    with pytest.raises(ValueError, match="no version 3"):
        counts(spark, table, 3)


@pytest.mark.parametrize("step", ["save", "roll_up", "publish", "write", "rename", "after"])
def test_killed_between_any_two_steps(spark, tmp_path, source, monkeypatch, step):
    table = str(tmp_path / "trips")
    write(source, "2024-01", 3)
    load(spark, source, table, "2024-01")
    write(source, "2024-01", 0)
    write(source, "2024-02", 6)

    def killed(*_, **__):
        raise Killed

    if step in ("save", "roll_up", "publish"):
        monkeypatch.setattr(ingest, step, killed)
    elif step == "after":
        plain = versions.Store.rename
        monkeypatch.setattr(versions.Store, "rename", lambda *a: (plain(*a), killed()))
    else:
        monkeypatch.setattr(versions.Store, step, killed)
    with pytest.raises(Killed):
        load(spark, source, table, "2024-02")
    monkeypatch.undo()
    new = {"2024-02": 6}
    assert counts(spark, table) == (new if step == "after" else {"2024-01": 3})
    load(spark, source, table, "2024-02")
    assert counts(spark, table) == new


def test_two_loads_at_the_same_time(spark, tmp_path, source):
    table = str(tmp_path / "trips")
    for month in ("2024-01", "2024-02", "2024-03"):
        write(source, month, 2)

    def one(month):
        run_load(spark, str(source), table, ["yellow"], month, month)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(one, ("2024-01", "2024-02", "2024-03")))
    assert counts(spark, table) == {"2024-01": 2, "2024-02": 2, "2024-03": 2}
    assert versions.versions(spark, table) == [1, 2, 3]


def test_a_taken_number_is_not_overwritten(spark, tmp_path):
    store = versions.Store(spark, str(tmp_path))
    store.write(f"{tmp_path}/a", "first")
    store.write(f"{tmp_path}/b", "second")
    assert not store.rename(f"{tmp_path}/b", f"{tmp_path}/a")
    assert (tmp_path / "a").read_text() == "first"


def test_old_versions_go(spark, tmp_path, source):
    table = str(tmp_path / "trips")
    for rows in (1, 2, 3):
        write(source, "2024-01", rows)
        load(spark, source, table, "2024-01")
    assert versions.remove_old(spark, table, keep=3) == []
    removed = versions.remove_old(spark, table, keep=2)
    assert len(removed) == 1 + len(MONTHLY)
    assert versions.versions(spark, table) == [2, 3]
    assert counts(spark, table, 2) == {"2024-01": 2} and counts(spark, table) == {"2024-01": 3}
    with pytest.raises(ValueError, match="has to stay"):
        versions.remove_old(spark, table, keep=0)


def test_a_broken_part_is_put_aside(spark, tmp_path, source, zones_dir):
    table = str(tmp_path / "trips")
    month = source / "yellow_tripdata_2024-01.parquet"
    month.mkdir()
    for i in range(3):
        write_trips([trip(VendorID=i)], month / f"part-{i}.parquet")
    whole = (month / "part-1.parquet").read_bytes()
    (month / "part-1.parquet").write_bytes(b"no footer here" * 99)
    outcome = load(spark, source, table, "2024-01").collect()
    assert [(r.action, r.rejected) for r in outcome] == [("load", ["part-1.parquet"])]
    assert sorted(r.VendorID for r in read_table(spark, table).collect()) == [0, 2]
    assert [r.rejected for r in versions.entries(spark, table).collect()] == [["part-1.parquet"]]
    # The job stops, unless it is told to go on; a whole month is no longer incomplete.
    args = [spark, str(source), table, str(tmp_path / "out"), f"{zones_dir}/taxi_zones.csv", ["yellow"], "2024-01", "2024-01"]
    with pytest.raises(RuntimeError, match="2024-01"):
        job.run(*args)
    assert "top-zones" in job.run(*args, allow_missing=True)
    (month / "part-1.parquet").write_bytes(whole)
    assert [r.rejected for r in load(spark, source, table, "2024-01").collect()] == [[]]
    assert [r.action for r in load(spark, source, table, "2024-01").collect()] == ["skip"]
    assert sorted(r.VendorID for r in read_table(spark, table).collect()) == [0, 1, 2]


def test_damaged_pages_are_put_aside(spark, tmp_path, source):
    # The footer is sound, so the damage shows only when the rows are read.
    month = source / "yellow_tripdata_2024-01.parquet"
    month.mkdir()
    for i in range(2):
        write_trips([trip(VendorID=7 * i + j % 3, fare_amount=j * 1.5) for j in range(3000)], month / f"part-{i}.parquet")
    data = bytearray((month / "part-0.parquet").read_bytes())
    data[4 : len(data) // 2] = b"\x99" * (len(data) // 2 - 4)
    (month / "part-0.parquet").write_bytes(bytes(data))
    table = str(tmp_path / "trips")
    outcome = load(spark, source, table, "2024-01").collect()
    assert [(r.action, r.rejected) for r in outcome] == [("load", ["part-0.parquet"])]
    assert counts(spark, table) == {"2024-01": 3000}


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_load_reduces_its_own_month_only(spark, tmp_path, source, monkeypatch):
    table = str(tmp_path / "trips")
    write(source, "2024-01", 3)
    load(spark, source, table, "2024-01")
    write(source, "2024-02", 5)
    plans = []
    plain = ingest.save

    def watched(frame, path, **options):
        plans.append((path, plan_text(frame)))
        plain(frame, path, **options)

    monkeypatch.setattr(ingest, "save", watched)
    load(spark, source, table, "2024-02")
    assert len(plans) == 1 + len(MONTHLY)
    assert not any("month=2024-01" in path or "2024-01" in plan for path, plan in plans)
    assert all("load=" in plan for path, plan in plans if "_parts" in path)


def test_reports_from_merged_months(spark, tmp_path, source, zones_dir):
    table = str(tmp_path / "trips")
    rows = [trip(total_amount=float(i % 9), PULocationID=1 + i % 2, passenger_count=float(i % 4)) for i in range(40)]
    for month, part in (("2024-01", rows[:11]), ("2024-02", rows[11:]), ("2024-03", [])):
        write_trips(part, source / f"yellow_tripdata_{month}.parquet")
    load(spark, source, table)
    trips, zones = read_table(spark, table), read_zones(spark, f"{zones_dir}/taxi_zones.csv")
    rollups = read_rollups(spark, table)
    assert set(rollups) == set(MONTHLY)
    for report in REPORTS.values():
        assert same(report.over(trips, zones, rollups).collect(), report.over(trips, zones).collect())
    for workload in WORKLOADS.values():
        assert same(workload.over(trips, rollups).collect(), workload.build(trips).collect())
    # Trips are scanned for the percentiles alone, and there once.
    for report in REPORTS.values():
        frame = report.over(trips, zones, rollups)
        frame.collect()
        scans = [x for x in plan_text(frame).split("Initial Plan")[0].splitlines() if "FileScan parquet" in x]
        facts = [x for x in scans if "_parts" not in x]
        assert len(facts) == (report.name == "duration-percentiles"), report.name
    # Before any load there is nothing to read.
    assert read_table(spark, str(tmp_path / "none")).count() == 0
    assert all(f.count() == 0 for f in read_rollups(spark, str(tmp_path / "none")).values())


def test_clustered_months(spark, tmp_path, source):
    table = str(tmp_path / "trips")
    rows = [trip(tpep_pickup_datetime=NOON + dt.timedelta(hours=i * 37 % 700), fare_amount=float(i)) for i in range(700)]
    write_trips(rows, source / "yellow_tripdata_2024-01.parquet")
    run_load(spark, str(source), table, ["yellow"], "2024-01", "2024-01", file_rows=100)
    files = sorted((tmp_path / "trips").glob("taxi_type=yellow/month=2024-01/load=*/*.parquet"))
    ends = sorted((min(x), max(x)) for x in (pq.read_table(f)["tpep_pickup_datetime"].to_pylist() for f in files))
    assert len(ends) == 7 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert counts(spark, table) == {"2024-01": 700}


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared_folder(cluster)
