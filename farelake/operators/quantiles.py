"""Exact interpolated quantiles of a bounded integer column, without a single-task merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(
    rows: DataFrame, bucket: Column, value: Column, unit: float = 1.0, keys: Sequence[Column] = ()
) -> DataFrame:
    """Rows and their sum of `value` (in `unit`s) per bucket, and per key. Histograms of parts of the rows add up."""
    return rows.groupBy(*keys, bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("inside"), F.sum(value / F.lit(unit)).alias("in_amount")
    )


def exact_quantiles(
    rows: DataFrame,
    bucket: Column,
    value: Column,
    quantiles: Mapping[str, float],
    max_buckets: int,
    unit: float = 1.0,
    known: DataFrame | None = None,
) -> DataFrame:
    """One row: every quantile of the integer `value` (in `unit`s, interpolated), plus `mean` and `rows`.

    `bucket` is a coarse, cheap key that rises with `value`. The rows are read twice:

    1. they are counted per bucket, so partial aggregation leaves at most `max_buckets` rows per task
       to shuffle, and the running total of the counts tells which few buckets hold the wanted ranks;
    2. only the rows in those buckets, at most two per quantile, are counted per value and ranked.

    With `known`, histograms of the very same rows in any number of parts, the first reading is spared.

    The built-in `percentile` would merge all distinct values in one task. More than `max_buckets`
    buckets stop the query: the running total is taken in one task.
    """
    if known is None:
        counted = histogram(rows, bucket, value, unit)
    else:
        counted = known.groupBy("bucket").agg(F.sum("inside").alias("inside"), F.sum("in_amount").alias("in_amount"))
    total = "OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING)"
    running = counted.selectExpr(
        "bucket AS wanted_bucket",
        "inside",
        f"sum(inside) {total} - inside AS before",
        "sum(inside) OVER () AS rows",
        "sum(in_amount) OVER () AS amount",
        f"assert_true(count(*) OVER () <= {max_buckets}, 'more than {max_buckets} buckets') AS checked",
    )
    # Zero-based position of each quantile among the rows, and the ranks below and above it.
    places = ", ".join(f"(rows - 1) * {p}D" for p in quantiles.values())
    ranks = f"flatten(transform(array({places}), p -> array(floor(p), ceil(p))))"
    wanted = running.withColumn("ranks", F.expr(ranks)).where(
        "checked IS NULL AND exists(ranks, r -> r >= before AND r < before + inside)"
    )

    # At most two buckets per quantile are left, so this side is broadcast whatever the data size.
    per_value = (
        rows.select(bucket.alias("wanted_bucket"), value.alias("v"))
        .join(F.broadcast(wanted.select("wanted_bucket")), "wanted_bucket", "left_semi")
        .groupBy("wanted_bucket", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = per_value.join(F.broadcast(wanted), "wanted_bucket").selectExpr(
        "v",
        "n",
        "rows",
        "amount",
        "ranks",
        "before + sum(n) OVER (PARTITION BY wanted_bucket ORDER BY v) - n AS start",
    )
    # One value per rank is left: at most two per quantile.
    row = (
        ranked.where("exists(ranks, r -> r >= start AND r < start + n)")
        .selectExpr("rows", "amount", "ranks", f"struct(start, n, v / {unit}D AS v) AS pick")
        .agg(
            F.max("rows").alias("rows"),
            F.max("amount").alias("amount"),
            F.max("ranks").alias("ranks"),
            F.collect_list("pick").alias("picks"),
        )
        .withColumn(
            "at",
            F.expr(
                "transform(ranks, r -> "
                "get(filter(picks, x -> r >= x.start AND r < x.start + x.n), 0).v)"
            ),
        )
    )

    def interpolated(i: int, p: float) -> str:
        lo, hi, share = f"at[{2 * i}]", f"at[{2 * i + 1}]", f"((rows - 1) * {p}D - ranks[{2 * i}])"
        return f"if({lo} = {hi}, {lo}, {lo} * (1 - {share}) + {hi} * {share})"

    return row.selectExpr(
        *[f"{interpolated(i, p)} AS {name}" for i, (name, p) in enumerate(quantiles.items())],
        "amount / rows AS mean",
        "coalesce(rows, 0L) AS rows",
    )
