"""A third of all rows under one key: results stay whole, and no task gets the hot group whole."""

from __future__ import annotations

import duckdb
import pytest

from checks.oracles import ORACLES
from checks.registry import QUERIES
from farelake import bindings

HOT = 60_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Lineitems of which one order, supplier, part and line hold a third."""
    folder = tmp_path_factory.mktemp("skew")
    hot = f"id < {HOT}"
    spark.range(3 * HOT).selectExpr(
        f"if({hot}, 77, id % 5000) AS l_orderkey",
        f"if({hot}, 5, id % 997) AS l_partkey",
        f"if({hot}, 3, id % 40) AS l_suppkey",
        f"int(if({hot}, 1, 1 + id % 7)) AS l_linenumber",
        "double(1 + id % 50) AS l_quantity",
        "double(900 + id % 90000) AS l_extendedprice",
        "(id % 11) / 100D AS l_discount",
        "0.02D AS l_tax",
        "'N' AS l_returnflag",
        "'O' AS l_linestatus",
        "timestamp_ntz'1998-01-01' AS l_shipdate",
    ).repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(5000).selectExpr(
        "id AS o_orderkey",
        "id AS o_custkey",
        "'O' AS o_orderstatus",
        "1000D AS o_totalprice",
        "timestamp_ntz'1996-01-01' + (id % 900) * INTERVAL 1 DAY AS o_orderdate",
        "'5-LOW' AS o_orderpriority",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(40).selectExpr(
        "id AS s_suppkey", "'s' AS s_name", "int(id % 5) AS s_nationkey", "1D AS s_acctbal"
    ).write.parquet(f"{folder}/supplier.parquet")
    spark.range(5).selectExpr(
        "int(id) AS n_nationkey", "concat('N', id) AS n_name", "int(id % 2) AS n_regionkey"
    ).write.parquet(f"{folder}/nation.parquet")
    spark.range(2).selectExpr(
        "int(id) AS r_regionkey", "concat('R', id) AS r_name"
    ).write.parquet(f"{folder}/region.parquet")
    return str(folder)


@pytest.fixture
def sort_merge_joins(spark):
    """Join sizes as on a cluster: nothing small enough to broadcast, hot partitions split early."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "qb" and n != "q11_run_all_rows"])
def test_results_stay_whole(spark, folder, sort_merge_joins, name):
    con = duckdb.connect()
    for table in ("lineitem", "orders", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    frame = QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(columns).collect()]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_run_all_joins_the_order_dates_once(spark, folder, sort_merge_joins):
    """The reports read saved lines with their dates; none joins the orders again."""
    frame = QUERIES["q11_run_all_rows"](spark, folder)
    assert not [file for file in frame.inputFiles() if "/orders.parquet" in file or "/lineitem.parquet" in file]
    con = duckdb.connect()
    for table in ("lineitem", "orders", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    want = con.execute(f"SELECT report, n_rows FROM ({ORACLES['q11_run_all_rows']})").fetchall()
    assert sorted((r.report, r.n_rows) for r in frame.collect()) == sorted(want)


def test_trips_of_dated_lines(spark, folder):
    """The same trips either way, in every column."""
    made = bindings.trips_of(bindings.dated_lines(spark, folder))
    straight = bindings.trips(spark, folder)
    assert made.schema == straight.schema
    assert made.exceptAll(straight).isEmpty() and straight.exceptAll(made).isEmpty()


def test_hot_order_is_split(spark, folder, sort_merge_joins):
    frame = QUERIES["q02_hourly_revenue"](spark, folder)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_zone_reaches_the_join_as_one_row_per_id(spark, folder, sort_merge_joins):
    """Aggregation before the shuffle: far fewer rows than trips are written to it."""
    frame = QUERIES["q01_top_zones"](spark, folder)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    partial = next(i for i, line in enumerate(lines) if "partial_count" in line)
    assert join < partial
