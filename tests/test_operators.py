from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.operators.aggregates import count_flags, group_count, mean, top_by_count
from farelake.operators.quantiles import exact_quantiles
from farelake.operators.timing import best_of, compare_engines
from farelake.operators.union import conform, union_by_name, widen, wider_type

QUANTILES = {"p50": 0.50, "p75": 0.75, "p90": 0.90, "p99": 0.99}


def quantiles_of(spark, numbers, width):
    frame = spark.createDataFrame([(n,) for n in numbers], "v bigint")
    bucket = F.floor(F.col("v") / width)
    return exact_quantiles(frame, bucket, F.col("v"), QUANTILES, max_buckets=100_001).collect()[0]


@pytest.mark.parametrize("seed", range(6))
def test_quantiles_match_brute_force(spark, seed):
    rng = random.Random(seed)
    size = rng.choice([1, 2, 3, 50, 400])
    top = rng.choice([3, 100, 100_000])
    numbers = [rng.randrange(top) for _ in range(size)]
    got = quantiles_of(spark, numbers, width=rng.choice([1, 10, 1000]))
    for name, p in QUANTILES.items():
        assert got[name] == pytest.approx(np.quantile(numbers, p), rel=1e-12)
    assert got["mean"] == pytest.approx(np.mean(numbers))
    assert got["rows"] == size


def test_quantiles_with_one_hot_value(spark):
    numbers = [7] * 3000 + list(range(6000))
    got = quantiles_of(spark, numbers, width=100)
    assert [got[n] for n in QUANTILES] == pytest.approx(np.quantile(numbers, [0.5, 0.75, 0.9, 0.99]))


def test_too_many_buckets_stop_the_query(spark):
    frame = spark.range(50)
    found = exact_quantiles(frame, F.col("id"), F.col("id"), QUANTILES, max_buckets=49)
    with pytest.raises(Exception, match="more than 49 buckets"):
        found.collect()


def test_quantiles_of_nothing(spark):
    got = quantiles_of(spark, [], width=10)
    assert got["rows"] == 0 and all(got[n] is None for n in (*QUANTILES, "mean"))


def test_flags_keep_zero_rows(spark):
    empty = spark.createDataFrame([], "x int")
    rows = count_flags(empty, {"a": F.col("x") > 0, "b": F.col("x") < 0}).collect()
    assert [tuple(r) for r in rows] == [("a", 0), ("b", 0)]


def test_missing_keys(spark):
    rows = [(1.0,), (1.0,), (None,), (float("nan"),), (float("nan"),)]
    frame = spark.createDataFrame(rows, "k double")
    kept = {str(r.k): r.n for r in group_count(frame, F.col("k"), "k").collect()}
    assert kept == {"1.0": 2, "None": 1, "nan": 2}
    dropped = group_count(frame, F.col("k"), "k", keep_missing=False).collect()
    assert [tuple(r) for r in dropped] == [(1.0, 2)]


def test_nan_in_mean(spark):
    frame = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    spread, skipped = frame.agg(mean(F.col("x")), mean(F.col("x"), skip_nan=True)).collect()[0]
    assert math.isnan(spread) and skipped == 2.0


def test_ties_at_the_cut(spark):
    frame = spark.createDataFrame([(f"z{i:02}", 5) for i in range(12)] + [(None, 5)], "k string, n int")
    rows = top_by_count(frame, "n", ["k"], 10).collect()
    assert [r.k for r in rows] == [f"z{i:02}" for i in range(10)]


ENGINES = ["a", "b", "c"]
ELAPSED = st.sampled_from([0.0, 0.25, 0.5, 2.0])
TIMED = st.lists(st.tuples(st.sampled_from(["w1", "w2", "w3"]), st.sampled_from(ENGINES), ELAPSED), min_size=1, max_size=20)
ONCE = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@ONCE
@given(TIMED)
def test_compare_engines(spark, runs):
    rows = [(w, e, t, i) for i, (w, e, t) in enumerate(runs)]
    frame = spark.createDataFrame(rows, "workload string, engine string, elapsed_s double, seq int")
    wide = compare_engines(frame, ENGINES, slow="c", fast="a")
    assert wide.columns == ["workload", *ENGINES, "speedup"]
    latest = {(w, e): t for w, e, t in runs}
    for row in wide.collect():
        times = [latest.get((row.workload, e), math.nan) for e in ENGINES]
        assert [repr(row[e]) for e in ENGINES] == [repr(t) for t in times]
        fast, slow = times[0], times[2]
        assert repr(row.speedup) == repr(slow / fast if fast > 0 else 0.0)
    assert [r.workload for r in wide.collect()] == sorted({w for w, _, _ in runs})


@ONCE
@given(TIMED)
def test_best_of(spark, runs):
    rows = [(e, w, t, 10 * i, i) for i, (w, e, t) in enumerate(runs)]
    frame = spark.createDataFrame(rows, "engine string, workload string, elapsed_s double, rows int, repeat int")
    want = {}
    for e, w, t, n, _ in rows:
        want[e, w] = (min(t, want.get((e, w), (t, 0))[0]), n)
    assert {(r.engine, r.workload): (r.elapsed_s, r.rows) for r in best_of(frame).collect()} == want


@pytest.mark.parametrize(
    ("left", "right", "want"),
    [
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.NullType(), T.StringType(), T.StringType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
    ],
)
def test_wider_type(left, right, want):
    assert wider_type(left, right) == want and wider_type(right, left) == want


def test_types_without_a_common_one():
    with pytest.raises(TypeError, match="no common type"):
        wider_type(T.BooleanType(), T.IntegerType())
    schemas = [T.StructType([T.StructField("flag", t)]) for t in (T.BooleanType(), T.LongType())]
    with pytest.raises(TypeError, match="column flag"):
        widen(schemas)


def test_doubles_become_integers_only_if_they_are(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (1e12,), (-0.0,)], "x double")
    wanted = T.StructType([T.StructField("x", T.LongType())])
    assert [r.x for r in conform(frame, wanted).collect()] == [1, None, None, 10**12, 0]
    for bad in (1.7, float("inf"), 1e300):
        broken = conform(spark.createDataFrame([(bad,)], "x double"), wanted)
        with pytest.raises(Exception, match="column x holds"):
            broken.collect()


def test_union_by_name_spelling_and_gaps(spark):
    left = spark.createDataFrame([(1, 2.0, 0.5)], "VendorID bigint, passengers double, Airport_fee double")
    right = spark.createDataFrame([(2, 3, 0.25, 9)], "VendorID int, passengers bigint, airport_fee double, extra int")
    both = union_by_name([left, right])
    assert both.dtypes == [
        ("VendorID", "bigint"),
        ("passengers", "double"),
        ("Airport_fee", "double"),
        ("extra", "int"),
    ]
    assert sorted(map(tuple, both.collect())) == [(1, 2.0, 0.5, None), (2, 3.0, 0.25, 9)]
