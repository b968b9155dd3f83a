"""The registered queries. Each reads whole tables of the given folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.oracles import BATCH_COLUMNS, ORACLES
from farelake import bindings
from farelake.functions import (
    day_of_week,
    month_start,
    round_half_away,
    seconds_between,
    split_list,
    to_int_half_even,
)
from farelake.operators.aggregates import group_count, mean, share_of_total
from farelake.operators.exact_sums import exact_sums
from farelake.operators.timing import best_of, compare_engines
from farelake.operators.topk import top_keys
from farelake.operators.union import union_by_name
from farelake.plans.ingest import expected_files, load_plan, load_summary, month_spine
from farelake.plans.job import run as run_job
from farelake.plans.reports import MONTHLY, REPORTS, daily_trend, hourly_revenue, run_all, weekend_vs_weekday
from farelake.plans.workloads import WORKLOADS, hourly_trip_count, top10_pickup_zones
from farelake.schemas import TAXI_TYPES
from farelake.sources.catalog import append, create
from farelake.sources.clustered import save_clustered
from farelake.sources.dimensions import payment_types
from farelake.sources.files import find_trip_files
from farelake.sources.scratch import new_folder, stored
from farelake.sources.store import Store
from farelake.sources.tables import display_text, save
from farelake.sources.trips import read_union_by_name
from farelake.sources.versions import ENTRY, entries, folder_of, new_load, publish, read_folders, versions
from farelake.sources.views import create_views, register_views

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["ORACLES", "QUERIES"]


def report(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        chosen = REPORTS[name]
        zones = bindings.zones(spark, folder) if chosen.with_zones else None
        return chosen.over(bindings.trips(spark, folder, chosen.reads), zones)

    return run


def workload(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        chosen = WORKLOADS[name]
        return chosen.build(bindings.trips(spark, folder, chosen.reads))

    return run


def long_trips_avg_fare(spark: SparkSession, folder: str) -> DataFrame:
    # Unrounded means differ in the last digits with the order of addition.
    return workload("filter_long_trips_avg_fare")(spark, folder).select(
        F.round("avg_fare", 6).alias("avg_fare")
    )


def long_trips_exact(spark: SparkSession, folder: str) -> DataFrame:
    trips = bindings.trips(spark, folder, ["trip_distance", "fare_amount"])
    return WORKLOADS["filter_long_trips_avg_fare"].build(trips, exact=True)


def exact_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Unrounded sums of prices and of signed, far smaller parts of them."""
    lines = bindings.table(spark, folder, "lineitem")
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1.0).otherwise(1.0)
    values = {"price": F.col("l_extendedprice"), "part": sign * F.col("l_extendedprice") / 3000.0}
    return exact_sums(lines, ["l_returnflag", "l_linestatus"], values)


def top_users(spark: SparkSession, folder: str) -> DataFrame:
    """The busiest users, of whom only those are counted that can be among them."""
    return top10_pickup_zones(bindings.event_trips(spark, folder), many_ids=True)


def top_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts that are ordered most often; one in three lines counts for part 1 to 9."""
    line = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    part = F.when(line % 3 == 0, 1 + line % 9).otherwise(F.col("l_partkey"))
    return top_keys(bindings.table(spark, folder, "lineitem"), part, "part", 25)


def bucketed_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and their lines as catalog tables in buckets of the order key; the later lines are appended."""
    names = [f"check_{uuid.uuid4().hex}" for _ in range(2)]
    orders = bindings.table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), "o_orderpriority")
    lines = bindings.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_quantity")
    create(orders, names[0], new_folder(spark, "orders"), "key", 8)
    place = new_folder(spark, "lines")
    create(lines.where("l_linenumber <= 3"), names[1], place, "key", 8, split=2)
    append(lines.where("l_linenumber > 3"), names[1], place, "key", 8)
    joined = spark.table(names[0]).join(spark.table(names[1]), "key", "left")
    per_order = joined.groupBy("key", "o_orderpriority").agg(F.sum("l_quantity").alias("quantity"))
    return per_order.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.max("quantity").alias("largest"), F.sum("quantity").alias("quantity")
    )


def clustered_days(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed in ranges of their date; a filter on days skips most of what it reads."""
    place = new_folder(spark, "days")
    orders = bindings.table(spark, folder, "orders").select("o_orderdate", "o_totalprice")
    save_clustered(orders, place, "o_orderdate", rows=2_000)
    days = spark.read.schema(orders.schema).parquet(place).where(
        "o_orderdate >= timestamp_ntz'1995-03-01' AND o_orderdate < timestamp_ntz'1995-03-15'"
    )
    return days.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("dearest")
    )


def on_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(bindings.event_trips(spark, folder))


def run_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per report of the run-all batch, every report from the trips themselves.

    Six reports read the times, so the join that gives them is done once and saved.
    """
    lines = stored(bindings.dated_lines(spark, folder), "lines")
    results = run_all(bindings.trips_of(lines), bindings.zones(spark, folder))
    counts = [
        frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(r.name).alias("report"), "n_rows")
        for r, frame in results
    ]
    return union_by_name(counts)


def percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """The trips are derived by a join, so their two times are saved; the report then reads them twice."""
    chosen = REPORTS["duration-percentiles"]
    return chosen.over(stored(bindings.trips(spark, folder, chosen.reads), "trip_times"))


def batch(spark: SparkSession, folder: str) -> DataFrame:
    """Every value of the batch, from rollups kept per month as a load keeps them, added up over the months."""
    trips, zones = stored(bindings.trips(spark, folder), "trips"), bindings.zones(spark, folder)
    month = F.date_format(bindings.PICKUP, "yyyy-MM").alias("month")
    rollups = {name: stored(build(trips, month), name) for name, build in MONTHLY.items()}
    cells = []
    for found, frame in run_all(trips, zones, rollups):
        keys, values = BATCH_COLUMNS[found.name]
        row_key = F.concat_ws("/", F.lit(""), *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        wide = frame.select(row_key.alias("row_key"), *[F.col(c).cast("double").alias(c) for c in values])
        long = wide.unpivot(["row_key"], values, "column_name", "value")
        cells.append(
            long.select(
                F.lit(found.name).alias("report"),
                "row_key",
                "column_name",
                F.round(F.col("value") * 1000).cast("bigint").alias("thousandths"),
            )
        )
    return union_by_name(cells)


def files_unioned(spark: SparkSession, folder: str) -> DataFrame:
    """Two of the tables' own files, read as one by name: shared names, others with gaps."""
    paths = [f"{folder}/customer.parquet", f"{folder}/supplier.parquet", f"{folder}/nation.parquet"]
    read = read_union_by_name(spark, paths)
    return read.groupBy("c_nationkey", "s_nationkey", "n_nationkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("c_acctbal"), 2).alias("c_total"),
        F.round(F.sum("s_acctbal"), 2).alias("s_total"),
        F.max("n_name").alias("n_name"),
    )


def drifting_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that share names, spelled and typed in three ways; read by the layouts that a first reading logged."""
    place = new_folder(spark, "drifting")

    def write(name: str, columns: list[str]) -> str:
        save(spark.read.parquet(f"{folder}/{name}.parquet").selectExpr(*columns), f"{place}/{name}.parquet")
        return f"{place}/{name}.parquet"

    paths = [
        write("customer", ["int(c_custkey) AS ID", "c_acctbal AS amount", "c_name AS Name"]),
        write("supplier", ["bigint(s_suppkey) AS id", "bigint(floor(s_acctbal)) AS Amount"]),
        write("nation", ["n_name AS label", "smallint(n_nationkey) AS Id", "float(n_regionkey) AS AMOUNT"]),
    ]
    read_union_by_name(spark, paths, f"{place}/layouts")
    rows = read_union_by_name(spark, paths, f"{place}/layouts")
    return rows.groupBy((F.col("ID") % 7).alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("Name").alias("names"),
        F.max("label").alias("label"),
        F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("cents"),
    )


def version_log(spark: SparkSession, folder: str) -> DataFrame:
    """Three versions of a table of orders by year: what readers of each of them see.

    The first holds the years before 1997. The second brings the later ones, replaces 1992 by its dear
    orders and 1993 by none, all at once. The third replaces 1994 by its urgent orders.
    """
    table = new_folder(spark, "orders")
    year = F.date_format("o_orderdate", "yyyy-01").alias("month")
    orders = bindings.table(spark, folder, "orders").select("o_totalprice", "o_orderpriority", year)
    columns = T.StructType([orders.schema["o_totalprice"], orders.schema["o_orderpriority"]])

    def load(rows: DataFrame, *emptied: str) -> None:
        name = new_load()
        keyed = rows.withColumns({"taxi_type": F.lit("orders"), "load": F.lit(name)})
        save(keyed, table, partition_by=["taxi_type", "month", "load"])
        for month in emptied:
            save(rows.select(columns.names).limit(0), folder_of(table, "orders", month, name))
        found = [*emptied, *[r.month for r in rows.select("month").distinct().collect()]]
        rows = [("orders", month, name, month, None, None, False, None, None) for month in found]
        publish(spark, table, spark.createDataFrame(rows, ENTRY))

    dear, urgent = F.col("o_totalprice") > 200000, F.col("o_orderpriority") == "1-URGENT"
    load(orders.where("month < '1997-01'"))
    load(orders.where((F.col("month") >= "1997-01") | ((F.col("month") == "1992-01") & dear)), "1993-01")
    load(orders.where((F.col("month") == "1994-01") & urgent))
    seen = []
    for version in versions(spark, table):
        held = read_folders(spark, table, entries(spark, table, version).collect(), columns)
        cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
        counted = held.groupBy("month").agg(F.count(F.lit(1)).alias("n"), cents.alias("cents"))
        seen.append(counted.select(F.lit(version).alias("version"), "month", "n", "cents"))
    return union_by_name(seen)


def _monthly_files(spark: SparkSession, folder: str, place: str) -> DataFrame:
    """The trips as three months of part files in `place`, the months dealt by payment type; and the zone CSV."""
    trips = stored(bindings.trips(spark, folder), "trips").withColumn(
        "month", F.concat(F.lit("2024-0"), 1 + F.pmod("payment_type", F.lit(3)))
    )
    for month in ("2024-01", "2024-02", "2024-03"):
        # One of the months has ids and counts of other types, and a column spelled in its own way.
        rows = trips.where(F.col("month") == month).drop("month")
        if month == "2024-02":
            rows = rows.withColumn("VendorID", F.col("VendorID").cast("int"))
            rows = rows.withColumnRenamed("total_amount", "Total_Amount")
        save(rows, f"{place}/yellow_tripdata_{month}.parquet")
    names = ["location_id AS LocationID", "borough AS Borough", "zone AS Zone", "service_zone"]
    header = bindings.zones(spark, folder).selectExpr(*names).write.option("header", True)
    header.mode("overwrite").csv(f"{place}/sample/taxi_zones.csv")
    return trips


def files_to_views(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly files and a zone CSV, found, registered and asked by SQL; the main folder is empty, so the sample counts."""
    place = new_folder(spark, "files")
    _monthly_files(spark, folder, place)
    chosen = find_trip_files(spark, f"{place}/none", place)
    found = register_views(spark, place, f"{place}/sample", log_dir=f"{place}/layouts")
    return spark.sql(
        f"""
        SELECT z.borough, {found} AS files, {len(chosen)} AS chosen, count(*) AS trips,
            sum(CAST(round(t.total_amount * 100) AS bigint)) AS cents, max(t.VendorID) AS vendor
        FROM trips t LEFT JOIN taxi_zones z ON t.PULocationID = z.location_id GROUP BY z.borough
        """
    )


def whole_job(spark: SparkSession, folder: str) -> DataFrame:
    """The job over monthly files, one part of which is broken, and one month of which is missing.

    What it says of the files, what it counts in them, and what two of its reports hold.
    """
    place = new_folder(spark, "job")
    _monthly_files(spark, folder, place)
    Store(spark, place).write(f"{place}/yellow_tripdata_2024-03.parquet/part-broken.parquet", "no Parquet file" * 9)
    table, out, zones = f"{place}/table", f"{place}/out", f"{place}/sample/taxi_zones.csv"
    run_job(spark, place, table, out, zones, ["yellow"], "2024-01", "2024-04", allow_missing=True)
    files = spark.read.parquet(f"{out}/load/files").select(
        F.lit("file").alias("kind"),
        F.concat_ws(" ", "month", "action", "rejected").alias("name"),
        F.lit(1).cast("bigint").alias("n"),
    )
    summary = spark.read.parquet(f"{out}/load/summary").unpivot(
        [], ["expected", "downloaded", "skipped", "failed"], "name", "n"
    )
    hours = spark.read.parquet(f"{out}/reports/hourly-revenue")
    lengths = spark.read.parquet(f"{out}/reports/duration-percentiles")
    return union_by_name(
        [
            files,
            summary.selectExpr("'summary' AS kind", "name", "bigint(n) AS n"),
            hours.selectExpr("'hour' AS kind", "string(hour_of_day) AS name", "trips AS n"),
            lengths.selectExpr("'median' AS kind", "string(p50_min) AS name", "trip_count AS n"),
        ]
    )


def adhoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text over the registered views."""
    create_views(bindings.trips(spark, folder), bindings.zones(spark, folder))
    return spark.sql(
        """
        SELECT z.borough, p.payment_label, count(*) AS trips, max(t.trip_distance) AS longest
        FROM trips t
        JOIN taxi_zones z ON t.PULocationID = z.location_id
        LEFT JOIN payment_types p ON t.payment_type = p.payment_type
        GROUP BY z.borough, p.payment_label
        """
    )


def union_drifted(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of the trips with drifted layouts, unioned by name and summed up."""
    lines = bindings.table(spark, folder, "lineitem")
    line = F.col("l_linenumber")
    early = lines.where(line <= 3).select(
        (1 + line % 2).cast("bigint").alias("VendorID"),
        line.cast("double").alias("passenger_count"),
        F.col("l_tax").alias("Airport_fee"),
    )
    late = lines.where(line > 3).select(
        (1 + line % 2).cast("int").alias("VendorID"),
        line.cast("bigint").alias("passenger_count"),
        F.col("l_tax").alias("airport_fee"),
        F.col("l_suppkey").cast("int").alias("extra_col"),
    )
    return (
        union_by_name([early, late])
        .groupBy("VendorID", "passenger_count")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("extra_col").alias("n_extra"),
            F.round(F.sum("Airport_fee"), 4).alias("fees"),
        )
    )


def inline_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Trips per code of the inline dimension, codes without trips and without label included."""
    codes = bindings.trips(spark, folder, ["payment_type"])
    counted = codes.groupBy("payment_type").agg(F.count(F.lit(1)).alias("trips"))
    labels = F.broadcast(payment_types(spark))
    return counted.join(labels, "payment_type", "left").select(
        "payment_type", "payment_label", "trips"
    )


def left_join_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """How many trips keep a zone, and how many stay with none."""
    per_id = group_count(
        bindings.trips(spark, folder, ["PULocationID"]), F.col("PULocationID"), "location_id"
    )
    joined = per_id.join(bindings.zones(spark, folder), "location_id", "left")
    return joined.groupBy(F.col("zone").isNotNull().alias("matched")).agg(
        F.sum("n").alias("trips"), F.count(F.lit(1)).alias("ids")
    )


def half_even_int(spark: SparkSession, folder: str) -> DataFrame:
    """Halves of the quantities, and NaN passengers, as integers."""
    quantities = bindings.table(spark, folder, "lineitem").select(
        to_int_half_even(F.col("l_quantity") / F.lit(2.0)).alias("half")
    )
    passengers = bindings.trips(spark, folder, ["passenger_count"]).select(
        to_int_half_even(F.col("passenger_count")).alias("half")
    )
    return quantities.unionAll(passengers).groupBy("half").agg(F.count(F.lit(1)).alias("n"))


def rounded(spark: SparkSession, folder: str) -> DataFrame:
    """Eighths of the prices, many of them ties, rounded to 0, 1 and 2 digits."""
    price = F.col("l_extendedprice") / F.lit(8.0)
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1.0).otherwise(1.0)
    parts = bindings.table(spark, folder, "lineitem").select(
        *[round_half_away(sign * price, d).alias(f"r{d}") for d in (0, 1, 2)], "l_linenumber"
    )
    cents = [
        F.sum((F.col(f"r{d}") * F.lit(float(10**d))).cast("decimal(20,2)").cast("bigint")).alias(
            f"r{d}_units"
        )
        for d in (0, 1, 2)
    ]
    return parts.groupBy("l_linenumber").agg(*cents)


def trip_seconds(spark: SparkSession, folder: str) -> DataFrame:
    """Signed trip lengths in seconds."""
    spans = bindings.trips(spark, folder, [bindings.PICKUP, bindings.DROPOFF]).select(
        seconds_between(F.col(bindings.PICKUP), F.col(bindings.DROPOFF)).alias("seconds")
    )
    return spans.groupBy("seconds").agg(F.count(F.lit(1)).alias("n"))


def event_seconds(spark: SparkSession, folder: str) -> DataFrame:
    """Fractional, signed seconds from the noon of 15 January 2024 to the events of each type."""
    noon = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    events = bindings.table(spark, folder, "events")
    seconds = seconds_between(noon, F.col("ts"))
    return events.groupBy("event_type").agg(
        F.min(seconds).alias("first_s"),
        F.max(seconds).alias("last_s"),
        F.count_if(seconds < 0).alias("before_noon"),
    )


def weekday_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day number (Sunday = 0) and calendar date."""
    events = bindings.table(spark, folder, "events")
    return events.groupBy(
        F.to_date("ts").alias("day"), day_of_week(F.col("ts")).cast("int").alias("dow")
    ).agg(F.count(F.lit(1)).alias("n"))


def share(spark: SparkSession, folder: str) -> DataFrame:
    """Share of each event type."""
    events = bindings.table(spark, folder, "events")
    counted = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # a handful of rows
    pct = round_half_away(share_of_total(counted, "n", total), 2)
    return counted.select("event_type", "n", pct.alias("pct_of_total"))


def missing_keys(keep: bool) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        trips = bindings.trips(spark, folder, ["passenger_count"])
        counted = group_count(trips, F.col("passenger_count"), "passengers", keep_missing=keep)
        # NaN never equals itself, so it is shown as text.
        label = F.when(F.isnan("passengers"), "NaN").otherwise(
            F.when(~F.isnan("passengers"), F.col("passengers")).cast("int").cast("string")
        )
        return counted.select(label.alias("passengers"), "n")

    return run


def nan_means(spark: SparkSession, folder: str) -> DataFrame:
    """Mean passengers per payment code: NaN spreading, and NaN left out."""
    value = F.col("passenger_count")
    trips = bindings.trips(spark, folder, ["passenger_count", "payment_type"])
    return trips.groupBy("payment_type").agg(
        F.isnan(mean(value)).alias("spreads"),
        F.round(mean(value, skip_nan=True), 6).alias("mean_skipping"),
    )


def _order_months(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.table(spark, folder, "orders")
    bounds = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return month_spine(bounds, F.col("lo"), F.col("hi"))


def _month_text(column: str) -> Column:
    return F.date_format(F.to_date(column), "yyyy-MM")


def months_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every month of the order range with its orders, and the dear and urgent ones among them."""
    orders = bindings.table(spark, folder, "orders")
    dear = (F.col("o_totalprice") > 400000) & (F.col("o_orderpriority") == "1-URGENT")
    month = F.trunc(F.to_date("o_orderdate"), "MM")
    # A month without a dear order has no row on the right, as a month without any trip would.
    counted = group_count(orders, month, "month_start").withColumnRenamed("n", "n_orders")
    rare = group_count(orders.where(dear), month, "month_start").withColumnRenamed("n", "n_dear")
    return (
        _order_months(spark, folder)
        .join(counted, "month_start", "left")
        .join(rare, "month_start", "left")
        .fillna(0, ["n_orders", "n_dear"])
    )


def files_expected(spark: SparkSession, folder: str) -> DataFrame:
    """Every file name that the order range implies."""
    return expected_files(_order_months(spark, folder), TAXI_TYPES)


def _listing(orders: DataFrame, size: str) -> DataFrame:
    """Orders as file sizes: the taxi type follows from the priority, the month from the date."""
    types = F.create_map(
        *[
            F.lit(part)
            for pair in zip(
                ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
                ("yellow", "green", "fhv", "fhvhv", "fhvhv"),
                strict=True,
            )
            for part in pair
        ]
    )
    name = F.format_string(
        "%s_tripdata_%s.parquet", types[F.col("o_orderpriority")], _month_text("o_orderdate")
    )
    return orders.groupBy(name.alias("file_name")).agg((F.count(F.lit(1)) * 64).alias(size))


def plan_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A load plan over listings that the orders imply.

    The source lacks May of odd years, and sizes that are multiples of 640 are unknown. The landed
    side lacks every sixth month and the cheapest orders.
    """
    orders = bindings.table(spark, folder, "orders")
    source = _listing(orders, "source_bytes").withColumn(
        "source_bytes", F.when(F.col("source_bytes") % 640 != 0, F.col("source_bytes"))
    )
    priced = orders.where((F.month("o_orderdate") % 6 != 0) & (F.col("o_totalprice") > 1200))
    landed = _listing(priced, "landed_bytes")
    odd = (F.month("o_orderdate") == 5) & (F.year("o_orderdate") % 2 == 1)
    missing = _listing(orders.where(odd), "ignored")
    source = source.join(missing, "file_name", "left_anti")
    return load_plan(files_expected(spark, folder), source, landed)


def summary_of_orders(spark: SparkSession, folder: str) -> DataFrame:
    return load_summary(plan_of_orders(spark, folder))


def months_parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Month texts built from orders, good and bad, and what they parse to."""
    orders = bindings.table(spark, folder, "orders")
    text = F.concat_ws(
        "-", F.year("o_orderdate").cast("string"), (F.col("o_custkey") % 15).cast("string")
    )
    return (
        orders.groupBy(text.alias("month_text"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("month_text", month_start(F.col("month_text")).alias("month_start"), "n")
    )


def lists_split(spark: SparkSession, folder: str) -> DataFrame:
    """Items of comma lists built from orders."""
    orders = bindings.table(spark, folder, "orders")
    text = F.concat_ws(",", "o_orderpriority", F.lit(" "), F.concat(F.lit(" "), "o_orderstatus"))
    items = orders.select(F.explode(split_list(text)).alias("item"))
    return items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as timed runs: the type is the workload, the user picks the engine."""
    return bindings.table(spark, folder, "events").select(
        F.col("event_type").alias("workload"),
        F.concat(F.lit("engine_"), F.col("user_id") % 3).alias("engine"),
        F.col("value").alias("elapsed_s"),
        F.col("event_id").alias("seq"),
        F.col("event_id").alias("repeat"),
        F.col("user_id").alias("rows"),
    )


def timing_best(spark: SparkSession, folder: str) -> DataFrame:
    return best_of(_runs(spark, folder))


def timing_pivot(spark: SparkSession, folder: str) -> DataFrame:
    engines = ["engine_0", "engine_1", "engine_2"]
    wide = compare_engines(_runs(spark, folder), engines, slow="engine_2", fast="engine_0")
    return wide.withColumn("speedup", F.round("speedup", 6))


def shown(spark: SparkSession, folder: str) -> DataFrame:
    """A report as text, nulls shown as a dash."""
    return display_text(report("tip-patterns")(spark, folder))


QUERIES: dict[str, Query] = {
    "q01_top_zones": report("top-zones"),
    "q02_hourly_revenue": report("hourly-revenue"),
    "q03_tip_patterns": report("tip-patterns"),
    "q04_duration_percentiles": percentiles,
    "q05_fare_per_mile": report("fare-per-mile"),
    "q06_weekend_vs_weekday": report("weekend-vs-weekday"),
    "q07_fraud_heuristics": report("fraud-heuristics"),
    "q08_top_routes": report("top-routes"),
    "q09_daily_trend": report("daily-trend"),
    "q10_passenger_distribution": report("passenger-distribution"),
    "q11_run_all_rows": run_all_rows,
    "q11_batch": batch,
    "b1_hourly_trip_count": workload("hourly_trip_count"),
    "b2_top10_pickup_zones": workload("top10_pickup_zones"),
    "b3_long_trips_avg_fare": long_trips_avg_fare,
    "b3_long_trips_exact": long_trips_exact,
    "op_exact_sums": exact_totals,
    "ev_top_users_threshold": top_users,
    "op_top_keys": top_parts,
    "op_bucketed_join": bucketed_join,
    "op_clustered_days": clustered_days,
    "ev_hourly": on_events(hourly_revenue),
    "ev_weekend": on_events(weekend_vs_weekday),
    "ev_daily": on_events(daily_trend),
    "ev_trip_count": on_events(hourly_trip_count),
    "ev_top_users": on_events(top10_pickup_zones),
    "op_adhoc_sql": adhoc_sql,
    "op_union_by_name": union_drifted,
    "op_union_files": files_unioned,
    "op_drifting_files": drifting_files,
    "op_version_log": version_log,
    "op_files_to_views": files_to_views,
    "op_whole_job": whole_job,
    "op_inline_dimension": inline_dimension,
    "op_left_join_unmatched": left_join_unmatched,
    "op_half_even_int": half_even_int,
    "op_round_half_away": rounded,
    "op_seconds_between": trip_seconds,
    "op_seconds_fractional": event_seconds,
    "op_day_of_week": weekday_numbers,
    "op_share_of_total": share,
    "op_null_keys_kept": missing_keys(keep=True),
    "op_null_keys_dropped": missing_keys(keep=False),
    "op_nan_mean_variants": nan_means,
    "op_month_spine": months_with_orders,
    "op_expected_files": files_expected,
    "op_load_plan": plan_of_orders,
    "op_load_summary": summary_of_orders,
    "op_month_parse": months_parsed,
    "op_split_list": lists_split,
    "op_best_of": timing_best,
    "op_timing_pivot": timing_pivot,
    "op_null_display": shown,
}
