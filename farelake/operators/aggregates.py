"""Small aggregate operators shared by reports, workloads and run summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_flags(frame: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Count every (possibly overlapping) condition in one pass; one row per flag, zeros included."""
    counted = frame.agg(*[F.count_if(condition).alias(flag) for flag, condition in flags.items()])
    return counted.unpivot([], list(flags), "flag", "hits")


def share_of_total(counted: DataFrame, count: str, total: Column) -> Column:
    """Percentage of `total`, a sum over the grouped rows, taken by each group's `count`."""
    return F.lit(100.0) * counted[count] / total


def group_count(frame: DataFrame, key: Column, name: str, keep_missing: bool = True) -> DataFrame:
    """Rows per key. `keep_missing=False` leaves out null and NaN keys, as data-frame libraries do."""
    keyed = frame.select(key.alias(name))
    if not keep_missing:
        keyed = keyed.dropna(subset=[name])
    return keyed.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def mean(value: Column, skip_nan: bool = False) -> Column:
    """Mean of a double column. NaN spreads to the result unless `skip_nan` is set."""
    return F.avg(F.when(~F.isnan(value), value)) if skip_nan else F.avg(value)


def top_by_count(counted: DataFrame, count: str, keys: Sequence[str], limit: int) -> DataFrame:
    """Largest counts first, ties settled by the keys (nulls last); planned as a top-k, not a sort."""
    ties = [F.asc_nulls_last(key) for key in keys]
    return counted.orderBy(F.desc(count), *ties).limit(limit)
