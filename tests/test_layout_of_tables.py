"""Top keys, tables in buckets and clustered files: results, and what is moved or read for them."""

from __future__ import annotations

import random
import uuid
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from farelake.operators.topk import top_keys
from farelake.plans.workloads import top10_pickup_zones
from farelake.sources.catalog import append, create, forget, reopen
from farelake.sources.clustered import save_clustered


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan()


def shuffled_rows(frame):
    frame.collect()
    written = []

    def walk(node):
        if node.nodeName() == "Exchange" and node.metrics().contains("shuffleRecordsWritten"):
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            walk(node.plan())

    walk(plan_of(frame))
    return sum(written)


def brute(values, limit, keep_missing=True):
    counts = Counter(v for v in values if keep_missing or v is not None)
    return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0]))[:limit]


@pytest.mark.parametrize("seed", range(4))
def test_top_keys_match_plain_counts(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([None, *range(rng.choice([3, 40, 500]))]) for _ in range(rng.choice([0, 5, 3000]))]
    values += [7] * rng.choice([0, 900])
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for keep in (True, False):
        found = top_keys(frame, F.col("v"), "v", 5, keep, buckets=rng.choice([1, 8, 1024]))
        assert [tuple(r) for r in found.collect()] == brute(values, 5, keep)


def test_rare_keys_are_not_moved(spark):
    # 300,000 keys that occur once, and 40 that hold half of all rows.
    rows = spark.range(0, 600_000, 1, 4).selectExpr("CASE WHEN id % 2 = 0 THEN pmod(hash(id), 40) ELSE id END AS PULocationID")
    plain, quick = top10_pickup_zones(rows), top10_pickup_zones(rows, many_ids=True)
    assert quick.collect() == plain.collect()
    assert shuffled_rows(plain) > 300_000 and shuffled_rows(quick) < 3_000


@pytest.fixture
def tables(spark, tmp_path):
    names = [f"t{uuid.uuid4().hex}" for _ in range(2)]
    yield [(name, str(tmp_path / name)) for name in names]
    for name in names:
        forget(spark, name)


def months(spark, rows, name):
    return spark.range(rows).selectExpr("if(id % 3 = 0, 1, id % 500) AS month", f"id AS {name}")


def test_tables_in_buckets_join_without_an_exchange(spark, tables):
    (a, place_a), (b, place_b) = tables
    create(months(spark, 3000, "x"), a, place_a, "month", 4, split=3)
    create(months(spark, 1000, "y"), b, place_b, "month", 4)
    append(months(spark, 500, "y").select("y", "month"), b, place_b, "month", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(a).join(spark.table(b), "month").groupBy("month").agg(F.count(F.lit(1)).alias("n"))
        text = plan_of(joined).toString()
        assert "Exchange" not in text and "SortMergeJoin" in text
        want = months(spark, 3000, "x").join(
            months(spark, 1000, "y").unionByName(months(spark, 500, "y")), "month"
        ).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
        assert sorted(joined.collect()) == sorted(want.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_tables_are_read_back_by_name(spark, tables):
    (a, place), _ = tables
    made = create(months(spark, 90, "x"), a, place, "month", 4)
    with pytest.raises(Exception, match="already exists"):
        create(months(spark, 1, "x"), a, place, "month", 4)
    with pytest.raises(ValueError, match="columns"):
        append(months(spark, 1, "other"), a, place, "month", 4)
    before = sorted(made.collect())
    schema = made.schema
    forget(spark, a)
    again = reopen(spark, a, place, schema, "month", 4)
    assert sorted(again.collect()) == before
    assert "Exchange" not in plan_of(again.groupBy("month").count()).toString()
    assert spark.newSession().table(a).count() == 90


def test_clustered_files_are_skipped(spark, tmp_path):
    # A third of all rows on one day.
    day = "timestamp_ntz'2024-01-01' + make_dt_interval(if(id % 3 = 0, 9, id % 31), 0, 0, id % 86400) AS at"
    rows = spark.range(0, 60_000, 1, 6).selectExpr(day, "id")
    save_clustered(rows, f"{tmp_path}/ranges", "at", rows=2_000)
    rows.write.parquet(f"{tmp_path}/plain")
    groups = {"plain": [0, 0], "ranges": [0, 0]}
    sizes = []
    for kind, told in groups.items():
        for file in (tmp_path / kind).glob("*.parquet"):
            footer = pq.ParquetFile(file).metadata
            sizes += [footer.num_rows] if kind == "ranges" else []
            for i in range(footer.num_row_groups):
                held = footer.row_group(i).column(0).statistics
                told[0] += held.min.day <= 20 <= held.max.day
                told[1] += 1
    assert groups["plain"][0] == groups["plain"][1]
    assert groups["ranges"][1] >= 20 and groups["ranges"][0] <= 3
    # The hot day is spread over files like any other.
    assert max(sizes) < 6_000
    for kind in groups:
        frame = spark.read.parquet(f"{tmp_path}/{kind}").where("to_date(at) = '2024-01-20' AND at >= '2024-01-20' AND at < '2024-01-21'")
        assert frame.count() == rows.where("to_date(at) = '2024-01-20'").count()
