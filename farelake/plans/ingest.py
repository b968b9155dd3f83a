"""Monthly load: what is expected, what must be loaded, the load itself, and its summary.

Every month is written to a folder of its own, with the rollups of just that month beside it. All months
of a load are published at once as a version of the table (`sources/versions.py`).
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake import schemas
from farelake.functions import file_name, month_start
from farelake.operators.union import CannotUnite, widen
from farelake.plans.reports import MONTHLY
from farelake.sources.clustered import save_clustered
from farelake.sources.files import list_files
from farelake.sources.tables import load as load_table
from farelake.sources.tables import save
from farelake.sources.trips import conform_trips, read_union_by_name
from farelake.sources.versions import ENTRY, entries, folder_of, new_load, present, publish, read_folders

log = logging.getLogger(__name__)

_FILE_PATTERN = r"([a-z]+)_tripdata_(\d{4}-\d{2})\.parquet"


def parse_month(text: str) -> date:
    """First day of a `YYYY-MM` argument."""
    match = re.fullmatch(r"(\d{1,4})-(\d{1,2})", text.strip())
    try:
        return date(int(match[1]), int(match[2]), 1)
    except (TypeError, ValueError):
        raise ValueError(f"not a YYYY-MM month: {text!r}") from None


def check_types(taxi_types: Iterable[str]) -> list[str]:
    """The given types, in order, when all are known."""
    given = list(taxi_types)
    for taxi_type in given:
        if taxi_type not in schemas.TAXI_TYPES:
            raise ValueError(
                f"unknown taxi_type {taxi_type!r}; known are {', '.join(schemas.TAXI_TYPES)}"
            )
    return given


def month_spine(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per month from `first` to `last`, both included, for every row of `bounds`."""
    start, end = F.trunc(first, "MM"), F.trunc(last, "MM")
    months = F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias("month_start"))


def months_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Months of an inclusive `YYYY-MM` range; ValueError when it is inverted or malformed."""
    if parse_month(start) > parse_month(end):
        raise ValueError(f"the first month, {start!r}, comes after end month {end!r}")
    return month_spine(spark.range(1), month_start(F.lit(start)), month_start(F.lit(end)))


def expected_files(months: DataFrame, taxi_types: Sequence[str]) -> DataFrame:
    """(taxi_type, month, file_name) for every type and month; the types are checked first."""
    types = F.array(*[F.lit(t) for t in check_types(taxi_types)])
    return months.select(F.explode(types).alias("taxi_type"), "month_start").select(
        "taxi_type",
        F.date_format("month_start", "yyyy-MM").alias("month"),
        file_name(F.col("taxi_type"), F.col("month_start")).alias("file_name"),
    )


def load_plan(expected: DataFrame, source: DataFrame, landed: DataFrame) -> DataFrame:
    """What to do with each expected file.

    `source` is (file_name, source_bytes) and `landed` (file_name, landed_bytes).
    No source row: `failed`. Landed with the same known size: `skip`. Landed with another size, or
    the source size is unknown: `reload`. Otherwise `load`. `bytes` is the size that is (or was)
    taken over. All three sides hold one row per file, so these are joins of listings, not of data.
    """
    there = source.select("file_name", "source_bytes", F.lit(True).alias("in_source"))
    here = landed.select("file_name", "landed_bytes", F.lit(True).alias("is_landed"))
    action = (
        F.when(F.col("in_source").isNull(), "failed")
        .when(F.col("is_landed").isNull(), "load")
        .when(F.col("source_bytes") == F.col("landed_bytes"), "skip")
        .otherwise("reload")
    )
    taken = F.when(F.col("action") == "skip", F.col("landed_bytes")).when(
        F.col("action") != "failed", F.col("source_bytes")
    )
    return (
        expected.join(there, "file_name", "left")
        .join(here, "file_name", "left")
        .withColumn("action", action)
        .select("taxi_type", "month", "file_name", "action", taken.alias("bytes"))
    )


def load_summary(plan: DataFrame) -> DataFrame:
    """One row: files expected, loaded, skipped and failed, and megabytes loaded (skips excluded)."""
    loaded = F.col("action").isin("load", "reload")
    loaded_bytes = F.coalesce(F.sum(F.when(loaded, F.col("bytes"))), F.lit(0))
    return plan.agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(loaded).alias("downloaded"),
        F.count_if(F.col("action") == "skip").alias("skipped"),
        F.count_if(F.col("action") == "failed").alias("failed"),
        (loaded_bytes / F.lit(1e6)).alias("megabytes"),
    )


def source_listing(spark: SparkSession, source_dir: str) -> DataFrame:
    """(file_name, source_bytes) of the monthly files in a folder.

    A month may be one file or a folder of part files; its size is the sum.
    """
    listing = list_files(spark, f"{source_dir}/*_tripdata_*.parquet")
    name = F.regexp_extract("path", _FILE_PATTERN, 0)
    return listing.groupBy(name.alias("file_name")).agg(F.sum("length").alias("source_bytes"))


def landed_listing(spark: SparkSession, table_dir: str, wanted: DataFrame) -> DataFrame:
    """(file_name, landed_bytes) of the `wanted` months that the newest version holds whole.

    A month whose folder is gone, or that landed without some of its parts, counts as not landed.
    """
    held = entries(spark, table_dir).join(wanted.select("taxi_type", "month"), ["taxi_type", "month"], "left_semi")
    whole = present(spark, table_dir, held.select(ENTRY.names)).where("coalesce(size(rejected), 0) = 0")
    return whole.select("file_name", F.col("bytes").alias("landed_bytes"))


def land_month(
    spark: SparkSession,
    paths: Sequence[str],
    table_dir: str,
    taxi_type: str,
    month: str,
    load: str,
    file_rows: int | None = None,
) -> T.StructType:
    """Write one month to its own folder, then its rollups, which read that folder alone; return its columns.

    Nothing is shuffled but the parts of the rollups. With `file_rows` the trips are shuffled once, into
    files of ranges of their pickup time, so that filters on days skip the others. Until a version names
    the folder nobody reads it.
    """
    rows = read_union_by_name(spark, paths)
    if taxi_type == "yellow":
        rows = conform_trips(rows, keep_extra=True)
        # One width per kind of number, so that the months of the table merge.
        wide = {T.IntegerType(): "bigint", T.ShortType(): "bigint", T.ByteType(): "bigint", T.FloatType(): "double"}
        further = [f for f in rows.schema if f.dataType in wide]
        rows = rows.withColumns({f.name: F.col(f"`{f.name}`").cast(wide[f.dataType]) for f in further})
    folder = folder_of(table_dir, taxi_type, month, load)
    if taxi_type == "yellow" and file_rows:
        save_clustered(rows, folder, "tpep_pickup_datetime", file_rows)
    else:
        save(rows, folder)
    if taxi_type == "yellow":
        roll_up(load_table(spark, folder, schemas.TRIPS), lambda part: folder_of(table_dir, taxi_type, month, load, part))
    return rows.schema


def roll_up(trips: DataFrame, place: Callable[[str], str]) -> None:
    """Write what the reports need of some trips, each rollup to its place."""
    for name, build in MONTHLY.items():
        save(build(trips), place(name))


def part_paths(spark: SparkSession, path: str) -> list[str]:
    """The part files of a month that is a folder; none of a month that is a file."""
    found = [row.path for row in list_files(spark, f"{path}/*").collect()]
    return sorted(part for part in found if part.rstrip("/") != path.rstrip("/"))


def land_parts(
    spark: SparkSession,
    path: str,
    table_dir: str,
    taxi_type: str,
    month: str,
    load: str,
    file_rows: int | None = None,
) -> tuple[T.StructType, list[str]]:
    """Land a month without those of its parts that cannot be read; return its columns and their names.

    An error that names a part puts that part aside, and the rest is tried again.
    """
    try:
        return land_month(spark, [path], table_dir, taxi_type, month, load, file_rows), []
    except (Py4JJavaError, PySparkException) as error:
        if not unreadable(error):
            raise
        parts, broken = part_paths(spark, path), error
    rejected: list[str] = []
    while True:
        named = [part for part in parts if part.rsplit("/", 1)[-1] in str(broken)]
        parts = [part for part in parts if part not in named]
        if not named or not parts:
            raise broken
        rejected += [part.rsplit("/", 1)[-1] for part in named]
        try:
            return land_month(spark, parts, table_dir, taxi_type, month, load, file_rows), sorted(rejected)
        except (Py4JJavaError, PySparkException) as error:
            if not unreadable(error):
                raise
            broken = error


#: What an unreadable file says; anything else that goes wrong is no fault of the file.
UNREADABLE = (
    "FAILED_READ_FILE",
    "CANNOT_READ_FILE",
    "UNABLE_TO_INFER_SCHEMA",
    "PATH_NOT_FOUND",
    "is not a Parquet file",
    "Could not read footer",
)


def unreadable(error: Exception) -> bool:
    return any(mark in str(error) for mark in UNREADABLE)


def run_load(
    spark: SparkSession,
    source_dir: str,
    table_dir: str,
    taxi_types: Sequence[str],
    start: str,
    end: str,
    at_once: int = 4,
    file_rows: int | None = None,
) -> DataFrame:
    """Bring the table up to date and return the plan with what happened to each file.

    Months are written `at_once` side by side and published together, in one version. A month whose file
    cannot be read is recorded as `failed`, a part of a month in `rejected`, and the rest still lands; any
    other error stops the load, after the months that are whole were published. `file_rows` clusters the
    files by pickup time. The plan has one row per type and month, which is what the driver holds.
    """
    expected = expected_files(months_between(spark, start, end), taxi_types)
    plan = load_plan(expected, source_listing(spark, source_dir), landed_listing(spark, table_dir, expected))
    load = new_load()

    def bring(step: Row) -> tuple:
        action, rejected, columns = step.action, [], None
        if action in ("load", "reload"):
            path = f"{source_dir}/{step.taxi_type}_tripdata_{step.month}.parquet"
            try:
                columns, rejected = land_parts(spark, path, table_dir, step.taxi_type, step.month, load, file_rows)
            except (Py4JJavaError, PySparkException, CannotUnite) as error:
                if not (isinstance(error, CannotUnite) or unreadable(error)):
                    raise
                log.error("Could not load %s: %s", step.file_name, error)
                action = "failed"
        size = None if action == "failed" else step.bytes
        return (step.taxi_type, step.month, step.file_name, action, size, rejected), columns

    steps = plan.orderBy("taxi_type", "month").collect()
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(bring, step) for step in steps]
    outcome = [done.result() for done in running if done.exception() is None]
    landed = [
        (taxi_type, month, load, name, size, columns.json(), taxi_type == "yellow", rejected, datetime.now())
        for (taxi_type, month, name, _, size, rejected), columns in outcome
        if columns is not None
    ]
    if landed:
        publish(spark, table_dir, spark.createDataFrame(landed, ENTRY))
    for done in running:
        done.result()
    schema = T.StructType([*plan.schema, T.StructField("rejected", T.ArrayType(T.StringType()))])
    return spark.createDataFrame([row for row, _ in outcome], schema)


def yellow_months(spark: SparkSession, table_dir: str, version: int | None = None) -> list[Row]:
    """The entries of the yellow months, in order."""
    return entries(spark, table_dir, version).where("taxi_type = 'yellow'").orderBy("month").collect()


def read_table(spark: SparkSession, table_dir: str, version: int | None = None) -> DataFrame:
    """The landed yellow trips with every column they came with, and `month` for pruning.

    Of the newest version, or of the given one. Declared columns come first; further ones are known from
    the version, so no footer is read.
    """
    months = yellow_months(spark, table_dir, version)
    columns = [T.StructType.fromJson(json.loads(r.columns)) for r in months]
    return read_folders(spark, table_dir, months, widen([schemas.TRIPS, *columns]))


def read_rollups(spark: SparkSession, table_dir: str, version: int | None = None) -> dict[str, DataFrame]:
    """The rollups of all yellow months of a version; those of one month only stand beside each other."""
    months = yellow_months(spark, table_dir, version)
    no_trips = spark.createDataFrame([], schemas.TRIPS)
    return {
        name: read_folders(spark, table_dir, months, build(no_trips).schema, part=name)
        for name, build in MONTHLY.items()
    }
