from __future__ import annotations

import logging
import math

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farelake import schemas
from farelake.sources.dimensions import payment_types, read_zones
from farelake.sources.files import find_trip_files, list_files
from farelake.sources.tables import display_text, load, print_table, save
from farelake.sources.trips import conform_trips, read_union_by_name
from farelake.sources.views import register_views
from helpers import COLUMNS, sql_rows, trip, write_trips


def write_month(folder, month, rows=1, taxi_type="yellow", types=None, **changes):
    path = folder / f"{taxi_type}_tripdata_{month}.parquet"
    return write_trips([trip(**changes)] * rows, path, types)


def test_falls_back_to_the_sample(spark, tmp_path):
    data, sample = tmp_path / "data", tmp_path / "sample"
    data.mkdir()
    sample.mkdir()
    assert find_trip_files(spark, str(data), str(sample)) == []
    assert find_trip_files(spark, str(tmp_path / "none"), str(sample)) == []
    write_month(sample, "2024-01")
    write_month(sample, "2024-01", taxi_type="green")
    assert [p.rsplit("/", 1)[1] for p in find_trip_files(spark, str(data), str(sample))] == [
        "yellow_tripdata_2024-01.parquet"
    ]
    for month in ("2024-03", "2024-02"):
        write_month(data, month)
    assert [p[-15:-8] for p in find_trip_files(spark, str(data), str(sample))] == ["2024-02", "2024-03"]


def test_a_month_may_be_a_folder_of_parts(spark, tmp_path):
    month = tmp_path / "yellow_tripdata_2024-01.parquet"
    spark.range(10).repartition(2).write.parquet(str(month))
    found = find_trip_files(spark, str(tmp_path), str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in found] == [month.name]
    assert read_union_by_name(spark, found).count() == 10


def test_listing_reads_no_content(spark, tmp_path):
    path = write_month(tmp_path, "2024-01")
    listing = list_files(spark, f"{tmp_path}/*.parquet")
    assert listing.collect()[0].length == len(open(path, "rb").read())
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan


def drifted(folder):
    """Five months, four layouts: widths, case, missing and extra columns."""
    base = {k: COLUMNS[k] for k in ("VendorID", "passenger_count", "Airport_fee", "total_amount")}
    lower = {("airport_fee" if k == "Airport_fee" else k): t for k, t in base.items()}
    layouts = [
        base,
        {**lower, "VendorID": pa.int32(), "passenger_count": pa.int64(), "extra_col": pa.int32()},
        {k: t for k, t in base.items() if k != "Airport_fee"},
        {**base, "passenger_count": pa.int64()},
        {**base, "total_amount": pa.float32(), "store_and_fwd_flag": pa.string()},
    ]
    paths = []
    for i, types in enumerate(layouts):
        row = {"VendorID": i, "passenger_count": i + 1, "total_amount": 0.5, "store_and_fwd_flag": "N"}
        row |= {"Airport_fee": 1.75, "airport_fee": 1.25, "extra_col": 7}
        paths.append(write_trips([row], folder / f"yellow_tripdata_2024-0{i + 1}.parquet", types))
    return paths


def test_union_by_name_matches_oracle(spark, tmp_path):
    paths = drifted(tmp_path)
    frame = read_union_by_name(spark, paths)
    assert dict(frame.dtypes) == {
        "VendorID": "bigint",
        "passenger_count": "double",
        "Airport_fee": "double",
        "total_amount": "double",
        "extra_col": "int",
        "store_and_fwd_flag": "string",
    }
    columns = ", ".join(frame.columns)
    want = sql_rows(f"SELECT {columns} FROM t ORDER BY 1", t=f"read_parquet({paths}, union_by_name=true)")
    assert [tuple(r) for r in frame.orderBy("VendorID").collect()] == want


def test_files_that_agree_share_one_scan(spark, tmp_path):
    paths = []
    for month in range(1, 9):
        types = {**COLUMNS, "passenger_count": pa.int64()} if month % 2 else COLUMNS
        paths.append(write_month(tmp_path, f"2024-0{month}", passenger_count=1, types=types))
    frame = read_union_by_name(spark, paths)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert frame.count() == 8


def test_drift_inside_a_month(spark, tmp_path):
    """Part files of one month that cannot be merged are told apart, and the rest still share."""
    month = tmp_path / "yellow_tripdata_2024-01.parquet"
    month.mkdir()
    for i in range(6):
        types = {**COLUMNS, "VendorID": pa.int32()} if i == 4 else COLUMNS
        write_trips([trip(VendorID=i)], month / f"part-{i}.parquet", types)
    frame = read_union_by_name(spark, find_trip_files(spark, str(tmp_path), str(tmp_path)))
    assert dict(frame.dtypes)["VendorID"] == "bigint"
    assert sorted(r.VendorID for r in frame.collect()) == list(range(6))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_filters_reach_every_scan_of_the_union(spark, tmp_path):
    frame = read_union_by_name(spark, drifted(tmp_path)).where("total_amount > 0").select("VendorID")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) > 1 and all("total_amount" in s.split("PushedFilters")[1] for s in scans)
    assert all("passenger_count" not in s for s in scans)


def test_conform_to_the_declared_schema(spark, tmp_path):
    union = read_union_by_name(spark, drifted(tmp_path))
    assert conform_trips(union).schema.simpleString() == schemas.TRIPS.simpleString()
    assert conform_trips(union, keep_extra=True).columns == [*schemas.TRIPS.names, "extra_col"]


def test_zones(spark, zones_dir):
    zones = read_zones(spark, f"{zones_dir}/taxi_zones.csv")
    assert zones.columns == ["location_id", "borough", "zone", "service_zone"]
    rows = {r.location_id: tuple(r)[1:] for r in zones.collect()}
    assert len(rows) == 6
    assert rows[264] == ("Unknown", "N/A", "N/A") and rows[265] == ("N/A", "Outside", "N/A")


def test_zone_header_is_checked(spark, tmp_path):
    (tmp_path / "z.csv").write_text("Borough,LocationID,Zone,service_zone\nQueens,1,Bay,Boro\n")
    with pytest.raises(Exception, match="header"):
        read_zones(spark, str(tmp_path / "z.csv")).collect()


def test_payment_types(spark):
    frame = payment_types(spark)
    assert frame.dtypes == [("payment_type", "int"), ("payment_label", "string")]
    assert [r.payment_label for r in frame.orderBy("payment_type").collect()] == [
        "Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip",
    ]


def test_register_views(spark, tmp_path, zones_dir):
    data = tmp_path / "data"
    data.mkdir()
    for month in ("2024-01", "2024-02"):
        write_month(data, month, rows=3)
    assert register_views(spark, str(data), str(zones_dir)) == 2
    assert {"trips", "taxi_zones", "payment_types"} <= {t.name for t in spark.catalog.listTables()}
    found = spark.sql(
        "SELECT z.zone, p.payment_label, count(*) AS n FROM trips t "
        "JOIN taxi_zones z ON t.PULocationID = z.location_id "
        "JOIN payment_types p USING (payment_type) GROUP BY ALL"
    )
    assert [tuple(r) for r in found.collect()] == [("Airport", "Credit card", 6)]


def test_register_views_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No parquet files"):
        register_views(spark, str(tmp_path), str(tmp_path))


def test_missing_zones_only_warn(spark, tmp_path, caplog):
    write_month(tmp_path, "2024-01")
    with caplog.at_level(logging.WARNING):
        assert register_views(spark, str(tmp_path), str(tmp_path)) == 1
    assert "taxi_zones.csv" in caplog.text


def test_saved_table_outlives_the_session(spark, tmp_path):
    path = str(tmp_path / "t")
    trips = spark.range(500).selectExpr("id", "id % 7 AS day", "CAST(id AS string) AS name")
    save(trips, path, partition_by=["day"])
    again = load(spark.newSession(), path, trips.schema)
    assert sorted(map(tuple, again.select("id", "day", "name").collect())) == sorted(map(tuple, trips.collect()))
    assert all(".zstd." in row.path for row in list_files(spark, f"{path}/*/*.parquet").collect())


def test_names_as_first_seen(spark, tmp_path):
    """Spelling, order and types over the files in order, as the oracle has them."""
    layouts = [
        {"id": pa.int64()},
        {"id": pa.int32(), "airport_fee": pa.float64()},
        {"id": pa.int64(), "Airport_fee": pa.float64(), "late": pa.int32()},
    ]
    paths = []
    for i, types in enumerate(layouts):
        row = {"id": i, "airport_fee": 0.5, "Airport_fee": 0.25, "late": 3}
        paths.append(write_trips([row], tmp_path / f"yellow_tripdata_2024-0{i + 1}.parquet", types))
    frame = read_union_by_name(spark, paths)
    oracle = duckdb.sql(f"FROM read_parquet({paths}, union_by_name=true)")
    assert frame.columns == oracle.columns == ["id", "airport_fee", "late"]
    assert [t for _, t in frame.dtypes] == ["bigint", "double", "int"]
    assert sorted(map(tuple, frame.collect())) == sorted(oracle.fetchall())


def test_a_stale_zone_view_goes(spark, tmp_path, zones_dir):
    write_month(tmp_path, "2024-01")
    register_views(spark, str(tmp_path), str(zones_dir))
    assert spark.catalog.tableExists("taxi_zones")
    register_views(spark, str(tmp_path), str(tmp_path))
    assert not spark.catalog.tableExists("taxi_zones")


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    save(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, partition_by=["k"])
    save(spark.createDataFrame([("b", 3)], "k string, v int"), path, partition_by=["k"])
    assert sorted((r.k, r.v) for r in load(spark, path).collect()) == [("a", 1), ("b", 3)]


def test_display_text(spark):
    rows = [(None, 1, 2064.0), ("x", None, None), ("y", 2, 12345678.25), ("z", 3, 1e7), ("w", 4, -2.5e9)]
    frame = display_text(spark.createDataFrame(rows, "s string, i int, d double"))
    assert [tuple(r) for r in frame.collect()] == [
        ("-", "1", "2064.0"),
        ("x", "-", "-"),
        ("y", "2", "12345678.25"),
        ("z", "3", "10000000.0"),
        ("w", "4", "-2500000000.0"),
    ]
    assert frame.where(F.col("s") == "-").count() == 1


DOUBLES = [
    0.0, -0.0, 1.0, -1.5, 0.1, 0.001, 0.0001, 0.00012345, 1e-5, -2.5e-7, 1e7, 12345678.9, 1e15, 123456789012345680.0,
    1e16, 1.5e16, -1e22, 1.7976931348623157e308, 1e-300, 0.3, 100.0, 9999999.0, 10000000.5, math.nan, math.inf, -math.inf,
]


def test_doubles_as_text(spark):
    frame = display_text(spark.createDataFrame([(d,) for d in DOUBLES], "d double"))
    assert [r.d for r in frame.collect()] == [str(d) for d in DOUBLES]
    flags = display_text(spark.createDataFrame([(True,), (False,), (None,)], "b boolean"))
    assert [r.b for r in flags.collect()] == ["True", "False", "-"]


def test_every_row_is_printed(spark, capsys):
    print_table(spark.range(10_001).selectExpr("id", "id / 2 AS half"))
    lines = capsys.readouterr().out.splitlines()
    assert len([line for line in lines if line.startswith("|")]) == 10_002
    assert lines[-2].split("|")[1:3] == [" 10000 ", " 5000.0 "]
