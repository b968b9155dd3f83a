"""Shape measured timings: best of several repeats, and engines side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_of(runs: DataFrame) -> DataFrame:
    """Fastest repeat per (engine, workload); the row count is that of the last repeat."""
    return runs.groupBy("engine", "workload").agg(
        F.min("elapsed_s").alias("elapsed_s"), F.max_by("rows", "repeat").alias("rows")
    )


def compare_engines(
    results: DataFrame, engines: Sequence[str], slow: str, fast: str, order: str = "seq"
) -> DataFrame:
    """One row per workload with a column per engine and the ratio slow / fast.

    The latest result (by `order`) wins, a missing engine is NaN, and the ratio is 0 unless the
    fast engine took a positive time. One conditional `max_by` per engine needs a single pass.
    """
    latest = [
        F.coalesce(
            F.max_by("elapsed_s", F.when(F.col("engine") == engine, F.col(order))),
            F.lit(float("nan")),
        ).alias(engine)
        for engine in engines
    ]
    # NaN > 0 holds in Spark, so it is ruled out by name.
    measurable = ~F.isnan(fast) & (F.col(fast) > 0)
    ratio = F.when(measurable, F.try_divide(F.col(slow), F.col(fast))).otherwise(F.lit(0.0))
    wide = results.groupBy("workload").agg(*latest)
    return wide.withColumn("speedup", ratio).orderBy("workload")
