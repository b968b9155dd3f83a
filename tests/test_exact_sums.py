"""Sums against the exact ones, and the same for every layout."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.registry import QUERIES
from conftest import SMALL
from farelake.operators.exact_sums import exact_sums
from farelake.plans.workloads import filter_long_trips_avg_fare


def summed(spark, lists):
    rows = [(k, x) for k, xs in enumerate(lists) for x in xs]
    frame = spark.createDataFrame(rows, "k int, x double")
    return {r.k: (r.total, r.total_n) for r in exact_sums(frame, ["k"], {"total": F.col("x")}).collect()}


def test_against_exact_sums(spark):
    rng = random.Random(1)
    lists = [
        [0.1] * 10,
        [1e16, 1.0, -1e16],
        [1e300, 1.0, 2.0**-1074, -1e300],
        [2.0**53, 1.0, 2.0**-30],
        [2.0**53, 1.0],
        [-(2.0**53), -1.0, -(2.0**-60)],
        [5e-324] * 7,
        [1.7e308, -1.7e308, 3.5],
        [0.0, -0.0],
        [65535.99999999999, 2.0**-16, -(2.0**16)],
    ]
    for _ in range(60):
        scale = rng.choice([1, 10, 300])
        some = [rng.uniform(-1, 1) * 10.0 ** rng.uniform(-scale, scale) for _ in range(rng.randrange(1, 40))]
        lists.append(some + [-x for x in some[: rng.randrange(len(some))]])
    got = summed(spark, lists)
    for k, xs in enumerate(lists):
        assert got[k] == (math.fsum(xs), len(xs)), xs


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.floats(-1e200, 1e200), min_size=1, max_size=30), min_size=20, max_size=20))
def test_any_doubles(spark, lists):
    got = summed(spark, lists)
    assert all(got[k] == (math.fsum(xs), len(xs)) for k, xs in enumerate(lists))


def test_nulls_and_endless_values(spark):
    nan, inf = float("nan"), float("inf")
    got = summed(spark, [[None], [None, 1.5], [nan, 1.0], [inf, 1.0], [-inf, 1.0], [inf, -inf]])
    assert got[0] == (None, 0) and got[1] == (1.5, 1)
    assert math.isnan(got[2][0]) and math.isnan(got[5][0])
    assert got[3][0] == inf and got[4][0] == -inf


@pytest.mark.parametrize("exact", [True, False])
def test_same_for_any_layout(spark, exact):
    rows = spark.range(200_000).selectExpr("5.5D + id % 9 AS trip_distance", "pow(1.37D, id % 60) * (id % 7 - 3) / 3 AS fare_amount")
    seen = set()
    for parts in (1, 7, 200):
        frame = rows.repartition(parts, "fare_amount") if parts > 1 else rows.coalesce(1)
        seen.add(filter_long_trips_avg_fare(frame, exact=exact).first()[0])
    assert len(seen) == 1 or not exact
    if exact:
        values = [r.fare_amount for r in rows.collect()]
        assert seen == {math.fsum(values) / len(values)}


def test_registered_query_stays_in_the_engine(spark):
    plan = QUERIES["op_exact_sums"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_sum" in plan
