"""A log of the layouts of monthly files, so that their footers are read once and not on every run.

A month is a file, or a folder of part files. Its state is the listing: names, lengths and times of
change. While that stays the same, the layouts found at the first reading hold; any change gives the
month another state, which is read and logged anew. The log is a folder of JSON lines, one file per run
that met something new, written under a hidden name and renamed; runs side by side do not disturb each
other, and what two of them log of one state is the same.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import chain

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from farelake.sources.store import Store

#: Part files of one layout, and the layout. A month has one of these, or several if its parts drift.
Run = tuple[list[str], T.StructType]

ENTRY = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("runs", T.StringType()),
    ]
)

#: Listings and first readings at a time.
AT_ONCE = 16


def state_of(store: Store, path: str) -> str:
    """What a month looks like from outside: a hash of its listing. No file is opened."""
    return hashlib.sha256(json.dumps(store.listing(path)).encode()).hexdigest()


def logged(spark: SparkSession, log_dir: str) -> dict[tuple[str, str], list[Run]]:
    """The layouts of the states met so far; one entry per month, whatever its size."""
    store = Store(spark, log_dir)
    if not any(name.endswith(".json") for name in store.names(log_dir)):
        return {}
    rows = spark.read.schema(ENTRY).json(f"{log_dir}/*.json").collect()
    return {
        (r.path, r.state): [(files, T.StructType.fromJson(schema)) for files, schema in json.loads(r.runs)]
        for r in rows
    }


def layouts(
    spark: SparkSession, paths: Sequence[str], read: Callable[[str], list[Run]], log_dir: str | None = None
) -> list[Run]:
    """The layouts of the months in the order of the paths; `read` finds those that the log does not know."""
    if log_dir is None:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            return list(chain.from_iterable(pool.map(read, paths)))
    known = logged(spark, log_dir)
    stores = Store(spark, paths[0]) if paths else None

    def found(path: str) -> tuple[str, list[Run], bool]:
        state = state_of(stores, path)
        runs = known.get((path, state))
        return state, runs if runs is not None else read(path), runs is None

    with ThreadPoolExecutor(AT_ONCE) as pool:
        told = list(pool.map(found, paths))
    lines = [
        json.dumps({"path": path, "state": state, "runs": json.dumps([[f, s.jsonValue()] for f, s in runs])})
        for path, (state, runs, new) in zip(paths, told, strict=True)
        if new
    ]
    if lines:
        store, name = Store(spark, log_dir), uuid.uuid4().hex
        store.write(f"{log_dir}/.{name}", "\n".join(lines) + "\n")
        store.rename(f"{log_dir}/.{name}", f"{log_dir}/{name}.json")
    return [run for _, runs, _ in told for run in runs]
