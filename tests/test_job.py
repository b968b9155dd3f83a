"""End to end: load months with drifting layouts, then write every report and workload."""

from __future__ import annotations

import pyarrow as pa
import pytest

from farelake.plans import job
from farelake.plans.reports import REPORTS
from farelake.plans.workloads import WORKLOADS
from farelake.sources.tables import load
from helpers import COLUMNS, sql_rows, trip, write_trips


def test_whole_job(spark, tmp_path, zones_dir, monkeypatch):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    early = [trip(PULocationID=p, passenger_count=float(p % 4)) for p in (1, 1, 2, 56, 57)]
    late = [trip(PULocationID=p, passenger_count=1, airport_fee=1.0) for p in (2, 264, -1)]
    drifted = {k: t for k, t in COLUMNS.items() if k != "Airport_fee"}
    drifted |= {"airport_fee": pa.float64(), "VendorID": pa.int32(), "passenger_count": pa.int64()}
    files = [
        write_trips(early, source / "yellow_tripdata_2024-01.parquet"),
        write_trips(late, source / "yellow_tripdata_2024-02.parquet", drifted),
    ]

    monkeypatch.setattr(job, "get_session", lambda: spark)
    table, zones = str(tmp_path / "trips"), f"{zones_dir}/taxi_zones.csv"
    args = ["--source", str(source), "--table", table, "--out", out, "--zones", zones]
    wanted = [*args, "--types", " Yellow,", "--start", "2024-01", "--end", "2024-03"]
    with pytest.raises(RuntimeError, match="2024-03"):
        job.main(wanted)
    # The loaded months are not loaded again.
    job.main([*wanted, "--allow-missing"])
    assert [r.month for r in load(spark, f"{out}/reports/_missing").collect()] == ["2024-03"]

    for name in REPORTS:
        assert load(spark, f"{out}/reports/{name}").columns
    summary = load(spark, f"{out}/load/summary").collect()[0]
    assert (summary.expected, summary.downloaded, summary.skipped, summary.failed) == (3, 0, 2, 1)
    assert load(spark, f"{out}/load/files").count() == 3

    top = load(spark, f"{out}/workloads/top10_pickup_zones")
    want = sql_rows(
        "SELECT PULocationID, COUNT(*) FROM t GROUP BY 1 ORDER BY 2 DESC, 1",
        t=f"read_parquet({files}, union_by_name=true)",
    )
    assert sorted(map(tuple, top.collect())) == sorted(want)
    assert {f"{out}/workloads/{w}" for w in WORKLOADS}

    # Views over the landed table stay open to SQL.
    assert spark.sql("SELECT sum(Airport_fee) FROM trips").collect()[0][0] == 3.0
