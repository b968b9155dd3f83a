"""Trips and zones derived from the order tables used for checks.

Every column is a plain arithmetic rule over `lineitem` (and `orders` for the date), so the same
rule reads alike in any SQL engine. The rules plant the cases the reports must handle: unmatched
keys, missing and NaN passengers, negative fares, long and reversed trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"

# Declared, so that no job has to read footers before the plan can be built.
TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}

_BASE_FARE = "(l_extendedprice / 1000D)"
_FARE = f"CASE l_orderkey % 1000 WHEN 0 THEN -{_BASE_FARE} WHEN 4 THEN 25D ELSE {_BASE_FARE} END"
_TIP = (
    f"CASE WHEN l_orderkey % 1000 = 5 THEN 0.75D * {_BASE_FARE} "
    f"WHEN l_orderkey % 7 = 2 THEN 0D ELSE {_BASE_FARE} * l_discount * 3 END"
)
_SECOND_OF_DAY = "int((l_orderkey * 7919 + l_partkey * 37 + l_linenumber * 1009) % 86400)"
_LENGTH = (
    "int(CASE l_orderkey % 1000 WHEN 2 THEN 28800 WHEN 3 THEN -300 "
    "ELSE 30 + (l_partkey * 131 + l_suppkey * 17 + l_linenumber * 7) % 5370 END)"
)

# Seconds after the midnight of the order date; the date itself needs the join.
SECONDS = {PICKUP: _SECOND_OF_DAY, DROPOFF: f"{_SECOND_OF_DAY} + {_LENGTH}"}

RULES = {
    "VendorID": "bigint(1 + l_linenumber % 2)",
    "passenger_count": (
        "CASE l_orderkey % 20 WHEN 0 THEN double('NaN') WHEN 1 THEN NULL "
        "ELSE double(l_linenumber) END"
    ),
    "trip_distance": (
        "CASE l_orderkey % 1000 WHEN 1 THEN 150D WHEN 4 THEN 0D ELSE l_quantity * 0.25D END"
    ),
    "PULocationID": "CASE WHEN l_orderkey % 250 = 0 THEN -1L ELSE l_suppkey END",
    "DOLocationID": "l_partkey % 10",
    "payment_type": "l_orderkey % 7",
    "fare_amount": _FARE,
    "tip_amount": _TIP,
    "total_amount": f"{_FARE} + {_TIP} + 1.5D",
}

# The columns of lineitem in the rules.
SOURCES = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Trip rows, one per lineitem, with the given columns (all by default).

    The order date comes from a left join on the order key, which is unique. So the join neither
    adds nor drops trips, and it is planned only when a timestamp is asked for. All else is computed
    below the join, so that the wanted columns are shuffled and not what they are made of.
    """
    wanted = list(columns or [*SECONDS, *RULES])
    facts = table(spark, folder, "lineitem")
    times = [name for name in wanted if name in SECONDS]
    rules = {**RULES, **SECONDS} if times else RULES
    facts = facts.selectExpr("l_orderkey", *[f"{rules[name]} AS {name}" for name in wanted])
    if times:
        dates = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
        facts = facts.join(dates, facts.l_orderkey == dates.o_orderkey, "left")
    moments = {name: f"timestampadd(SECOND, {name}, o_orderdate) AS {name}" for name in times}
    return facts.selectExpr(*[moments.get(name, name) for name in wanted])


def dated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every lineitem with the date of its order: what `trips_of` makes trips of.

    For jobs that want most columns of the trips more than once: these are fewer and more alike than the
    columns made of them, so joining and saving them moves less.
    """
    lines = table(spark, folder, "lineitem").select(*SOURCES)
    dates = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(dates, lines.l_orderkey == dates.o_orderkey, "left").drop("o_orderkey")


def trips_of(lines: DataFrame) -> DataFrame:
    """All columns of `trips`, from `dated_lines`."""
    moments = {name: f"timestampadd(SECOND, {sql}, o_orderdate)" for name, sql in SECONDS.items()}
    return lines.selectExpr(*[f"{sql} AS {name}" for name, sql in {**moments, **RULES}.items()])


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per supplier, named after its nation, with the region as borough."""
    supplier = table(spark, folder, "supplier")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "s_suppkey AS location_id",
            "r_name AS borough",
            "n_name AS zone",
            "r_name AS service_zone",
        )
    )


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream read as trips: time, user and value stand for pickup, place and amount."""
    return table(spark, folder, "events").selectExpr(
        f"ts AS {PICKUP}",
        "user_id AS PULocationID",
        "value AS total_amount",
        "0D AS tip_amount",
        "value AS trip_distance",
        "value AS fare_amount",
    )
