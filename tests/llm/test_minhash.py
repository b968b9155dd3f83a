"""Components against all pairs of full shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from conftest import SMALL
from farelake.llm import minhash
from farelake.llm.common import table
from farelake.llm.components import components
from samples import awkward, empty


def shingles(text, size):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def brute(rows, size, part, whole):
    sets = {i: shingles(t, size) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if (n := len(sets[a] & sets[b])) and whole * n >= part * (len(sets[a]) + len(sets[b]) - n)
    ]
    return {i: (len(sets[i]), root) for i, root in roots(ids, links).items()}


def near_group(n, seed=1):
    """Copies of one text with more and more words changed: many link, many do not."""
    rng = random.Random(seed)
    words = [f"v{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(n):
        copy = list(words)
        for k in rng.sample(range(150), rng.choice([0, 1, 2, 4, 6, 9])):
            copy[k] = f"x{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize(("size", "part"), [(3, 85), (5, 80)])
def test_against_all_pairs(spark, monkeypatch, size, part):
    # Small lots, so that strays and members of the group are dealt out.
    monkeypatch.setattr(minhash, "FEW", 16)
    monkeypatch.setattr(minhash, "MANY", 40)
    docs = table(spark, SMALL, "documents").selectExpr("doc_id + 5000 AS doc_id", "text").union(
        spark.createDataFrame(near_group(120), "doc_id long, text string")
    )
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, size, part).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], size, part, 100)


def test_awkward_rows_and_empty(spark):
    rows = minhash.near_duplicates(awkward(spark, "a b bucket label"), 3, 85).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert len(rows) == awkward(spark).count()
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True) and found[3] == (0, 3, True)
    assert found[4] == (1, 4, True) and found[5] == (1, 4, False) and found[6] == (1, 6, True)
    assert found[9][1:] == (8, False) and found[10][1:] == (10, True)
    assert found[2**62 + 1][1:] == (2**62 + 1, True)
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_estimate(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for same in (0.2, 0.6, 0.9):
        keep = int(4000 * 2 * same / (1 + same))
        other = np.unique(np.r_[base[:keep], rng.integers(0, 1 << 63, 4000 - keep, dtype=np.uint64)])
        bits = [minhash.packed(minhash.minima(x)).tolist() for x in (np.unique(base), other)]
        frame = spark.createDataFrame([tuple(bits)], "l array<long>, r array<long>")
        assert abs(frame.select(minhash.estimated("l", "r")).first()[0] - same) < 0.2


def test_strangers_stay_out_of_the_shuffle_of_own_shingles(spark, tmp_path):
    """Of 400 texts two are asked for; the rows that leave the first join of texts are few."""
    rows = [(i, f"a{i} b{i} c{i} same old words") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(f"{tmp_path}/docs")
    spark.createDataFrame([(7,), (9,)], "doc_id long").write.parquet(f"{tmp_path}/ids")
    docs, ids = spark.read.parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/ids")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        found = minhash.own_shingles(docs, ids, 3)
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        assert {(r.doc_id, r.own) for r in found.collect()} == {(7, 3), (9, 3)}
    finally:
        for key in conf:
            spark.conf.unset(key)
    depth = {name: next(len(line.split(name)[0]) for line in plan if name in line) for name in ("SortMergeJoin", "BroadcastHashJoin")}
    assert depth["BroadcastHashJoin"] > depth["SortMergeJoin"]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1080)] + [(2000, i) for i in range(1500, 1600)]
    want = roots({x for link in links for x in link}, links)
    frame = spark.createDataFrame([*links, (None, 5), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert {n: got.get(n, n) for n in want} == want
    assert components(frame.limit(0)).count() == 0
