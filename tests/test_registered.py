"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from checks.registry import ORACLES, QUERIES
from conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, oracle, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = [tuple(row) for row in frame.select(columns).collect()]
    result = oracle.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert got, "a registered query must return rows"


def test_entry_is_the_flagship(spark):
    assert contract.entry(spark).columns == [
        "borough",
        "zone",
        "trip_count",
        "avg_fare_usd",
        "total_revenue_usd",
    ]


def test_load_plan_meets_every_case(spark):
    actions = contract.queries()["op_load_plan"](spark, SMALL).select("action").distinct()
    assert {row.action for row in actions.collect()} == {"skip", "load", "reload", "failed"}


def test_fraud_flags_all_hit(spark):
    rows = contract.queries()["q07_fraud_heuristics"](spark, SMALL).collect()
    assert len(rows) == 6 and all(row.hits > 0 for row in rows)
