"""Monthly Parquet files as one frame, although their schemas drift."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from farelake import schemas
from farelake.operators.union import conform, widen
from farelake.sources.files import list_files
from farelake.sources.layouts import layouts

# Footer probes are small jobs; a few at a time keep the cluster from idling between them.
PROBES_AT_ONCE = 16


def _cannot_merge(error: Exception) -> bool:
    return "CANNOT_MERGE" in str(error)


def _schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    return spark.read.option("mergeSchema", True).parquet(*paths).schema


def _runs(spark: SparkSession, path: str) -> list[tuple[list[str], T.StructType]]:
    """The paths of one month with their schemas.

    A month usually has one writer, so merging its footers in one distributed job is the rule. Where
    that fails, the month is a folder whose files drift: they are probed one by one, side by side,
    and those of one schema stay together.
    """
    try:
        return [([path], _schema(spark, [path]))]
    except (Py4JJavaError, PySparkException) as error:
        if not _cannot_merge(error):
            raise
    parts = sorted(row.path for row in list_files(spark, f"{path.rstrip('/')}/*").collect())
    with ThreadPoolExecutor(PROBES_AT_ONCE) as pool:
        schemas = list(pool.map(lambda part: _schema(spark, [part]), parts))
    found: list[tuple[list[str], T.StructType]] = []
    for part, schema in zip(parts, schemas, strict=True):
        same = next((files for files, known in found if known == schema), None)
        if same is None:
            found.append(([part], schema))
        else:
            same.append(part)
    return found


def _agree(left: T.StructType, right: T.StructType) -> bool:
    types = {field.name.lower(): field.dataType for field in left}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in right)


def read_union_by_name(spark: SparkSession, paths: Sequence[str], log_dir: str | None = None) -> DataFrame:
    """Scan all files, columns matched by name without case, numbers widened, gaps null.

    With `log_dir` the layouts are kept there, and footers of unchanged files are not read again.

    Names are spelled and ordered as first seen over the paths in their order. Spark's `mergeSchema`
    adds columns but rejects int against bigint or double, and a declared read schema cannot turn a
    stored bigint into double. So files whose types agree share one scan, and only the handful of
    scans is unioned.
    """
    found = layouts(spark, paths, lambda path: _runs(spark, path), log_dir)
    names = widen([schema for _, schema in found])
    groups: list[tuple[list[str], T.StructType]] = []
    for run, schema in found:
        for i, (members, common) in enumerate(groups):
            if _agree(common, schema):
                groups[i] = (members + run, widen([common, schema]))
                break
        else:
            groups.append((run, schema))
    scans = [conform(spark.read.schema(s).parquet(*members), names) for members, s in groups]
    return reduce(DataFrame.unionAll, scans)


def conform_trips(frame: DataFrame, keep_extra: bool = False) -> DataFrame:
    """The declared trip columns with their declared types; further columns only on request."""
    declared = {name.lower() for name in schemas.TRIPS.names}
    extra = [f for f in frame.schema if f.name.lower() not in declared] if keep_extra else []
    return conform(frame, T.StructType([*schemas.TRIPS, *extra]))
