"""Versions of a monthly table: which folder holds which month, published by one rename.

    <table>/taxi_type=yellow/month=2024-01/load=<id>/...    written once, never changed
    <table>/_parts/<rollup>/taxi_type=.../month=.../load=<id>/...    what was reduced from that folder
    <table>/_versions/00000007.json                          one line per month that version 7 holds

A load writes new folders, which nobody reads yet, and then a new version, which names them beside the
folders of the months that stay. The version file is written under another name and renamed. So all
months of a load appear at once, an empty month replaces a full one like any other, and after a kill at
any point readers see the last version that was published. A version that two loads publish at the same
time goes to one of them; the other reads it and publishes the next one, with both loads' months.

Folders that no kept version names are removed by `remove_old`, never by a load.

The log has one row per month and taxi type, whatever the size of the months.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.sources.store import Store

ENTRY = T.StructType(
    [
        T.StructField("taxi_type", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("load", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("columns", T.StringType()),
        T.StructField("reduced", T.BooleanType()),
        T.StructField("rejected", T.ArrayType(T.StringType())),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

#: How often a publisher goes on to the next number when another one took it.
ATTEMPTS = 20


def _log(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/_versions"


def _file(table_dir: str, version: int) -> str:
    return f"{_log(table_dir)}/{version:08d}.json"


def versions(spark: SparkSession, table_dir: str) -> list[int]:
    """The published versions, oldest first."""
    names = Store(spark, table_dir).names(_log(table_dir))
    return [int(name[:8]) for name in names if name[:8].isdigit() and name.endswith(".json")]


def entries(spark: SparkSession, table_dir: str, version: int | None = None) -> DataFrame:
    """The months of a version (the newest by default); no rows when nothing was published yet."""
    known = versions(spark, table_dir)
    if version is None:
        if not known:
            return spark.createDataFrame([], ENTRY)
        version = known[-1]
    elif version not in known:
        raise ValueError(f"{table_dir} has no version {version}; it has {known}")
    return spark.read.schema(ENTRY).json(_file(table_dir, version))


def folder_of(table_dir: str, taxi_type: str, month: str, load: str, part: str | None = None) -> str:
    """Where a load keeps a month, or one of the parts reduced from it."""
    root = table_dir.rstrip("/") + (f"/_parts/{part}" if part else "")
    return f"{root}/taxi_type={taxi_type}/month={month}/load={load}"


def new_load() -> str:
    return uuid.uuid4().hex


def publish(spark: SparkSession, table_dir: str, changed: DataFrame) -> int:
    """Publish a version in which the `changed` months replace those of the newest one; return its number."""
    store, log = Store(spark, table_dir), _log(table_dir)
    changed = spark.createDataFrame(changed.select(ENTRY.names).collect(), ENTRY)
    for _ in range(ATTEMPTS):
        known = versions(spark, table_dir)
        stays = entries(spark, table_dir).join(changed, ["taxi_type", "month"], "left_anti")
        rows = stays.select(ENTRY.names).unionAll(changed).orderBy("taxi_type", "month")
        lines = [row.line for row in rows.select(F.to_json(F.struct("*")).alias("line")).collect()]
        fresh = f"{log}/.new-{uuid.uuid4().hex}"
        store.write(fresh, "\n".join(lines) + "\n")
        version = known[-1] + 1 if known else 1
        if store.rename(fresh, _file(table_dir, version)):
            return version
        store.remove(fresh)
    raise RuntimeError(f"others published {ATTEMPTS} versions of {table_dir} meanwhile")


def present(spark: SparkSession, table_dir: str, found: DataFrame) -> DataFrame:
    """Those of the entries whose folder is still there; one look per entry, no listing of the table."""
    store = Store(spark, table_dir)
    rows = [r for r in found.collect() if store.exists(folder_of(table_dir, r.taxi_type, r.month, r.load))]
    return spark.createDataFrame(rows, ENTRY)


def read_folders(
    spark: SparkSession, table_dir: str, rows: Sequence[T.Row], schema: T.StructType, part: str | None = None
) -> DataFrame:
    """The named months as one scan; `month` prunes it. No folder gives an empty frame."""
    wanted = T.StructType([f for f in schema if f.name not in ("taxi_type", "month", "load")])
    keyed = T.StructType([*wanted, *[T.StructField(n, T.StringType()) for n in ("taxi_type", "month", "load")]])
    columns = [f"`{f.name}`" for f in wanted] + ["month"]
    if not rows:
        return spark.createDataFrame([], keyed).select(columns)
    root = table_dir.rstrip("/") + (f"/_parts/{part}" if part else "")
    paths = [folder_of(table_dir, r.taxi_type, r.month, r.load, part) for r in rows]
    return spark.read.option("basePath", root).schema(keyed).parquet(*paths).select(columns)


def remove_old(spark: SparkSession, table_dir: str, keep: int) -> list[str]:
    """Forget all but the newest `keep` versions, then remove the folders that none of those names.

    Not to be run beside a load, whose folders no version names yet. Returns what was removed.
    """
    if keep < 1:
        raise ValueError("a version has to stay")
    store, known = Store(spark, table_dir), versions(spark, table_dir)
    for version in known[:-keep]:
        store.remove(_file(table_dir, version))
    kept = {
        (r.taxi_type, r.month, r.load)
        for version in known[-keep:]
        for r in entries(spark, table_dir, version).select("taxi_type", "month", "load").collect()
    }
    removed = []
    root = table_dir.rstrip("/")
    for base in [root, *[f"{root}/_parts/{name}" for name in store.names(f"{root}/_parts")]]:
        for kind in (n for n in store.names(base) if n.startswith("taxi_type=")):
            for month in store.names(f"{base}/{kind}"):
                for load in (n for n in store.names(f"{base}/{kind}/{month}") if n.startswith("load=")):
                    key = (kind.partition("=")[2], month.partition("=")[2], load.partition("=")[2])
                    if key not in kept:
                        store.remove(f"{base}/{kind}/{month}/{load}")
                        removed.append(f"{base}/{kind}/{month}/{load}")
    return removed
