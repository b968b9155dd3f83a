"""Links and components against brute force, and the audit of recall."""

from __future__ import annotations

import threading
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from farelake.llm import vectors
from farelake.llm.common import shared_folder
from farelake.sources.scratch import CLEANUP
from test_minhash import roots


def clouds(seed=4, dim=16):
    """Tight and looser groups, single vectors and equal ones."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(60, dim))]
    for size, spread in ((80, 0.02), (40, 0.08), (30, 0.15), (25, 0.0)):
        parts.append(rng.normal(size=dim) + spread * rng.normal(size=(size, dim)))
    return np.concatenate(parts).astype(np.float32)


def brute(matrix, ids):
    unit = matrix.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near)) if a < b]
    count = {i: int(n) - 1 for i, n in zip(ids, near.sum(axis=1))}
    return count, roots(ids, links)


def test_links(spark):
    data = clouds()
    ids = [int(i) * 3 + 1 for i in np.random.default_rng(1).permutation(len(data))]
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, data)], "vec_id long, embedding array<float>, label int")
    result = vectors.near_vectors(frame, shard=60)
    rows = result.collect()
    count, root = brute(data, ids)
    found = sum(min(r.n_links, count[r.vec_id]) for r in rows)
    assert len(rows) == len(ids) and all(r.n_links <= count[r.vec_id] for r in rows)
    assert found >= 0.97 * sum(count.values())
    assert np.mean([r.component_id == root[r.vec_id] for r in rows]) >= 0.97
    assert vectors.audit(frame, result, every=2, block=16) >= 0.95


def test_awkward_rows_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0),
        (2, [2.0, 0.0], 0),
        (2, [2.0, 0.0], 0),
        (3, None, 0),
        (4, [], 0),
        (5, [0.0, 0.0], 0),
        (6, [nan, 1.0], 0),
        (7, [inf, 1.0], 0),
        (8, [None, 1.0], 0),
        (9, [1.0, 0.0, 0.0], 0),
        (10, [1e300, 1e-300], 0),
        (11, [0.0, 1.0], 0),
        (None, [1.0, 0.0], 0),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.selectExpr("*", "1 AS node", "2 AS copies", "3 AS vector")
    got = {}
    for r in vectors.near_vectors(frame).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == [(2, 1, True)] and got[2] == [(2, 1, False)] * 2 and got[10] == [(2, 1, False)]
    for alone in (3, 4, 5, 6, 7, 8, 9, 11):
        assert got[alone] == [(0, alone, True)]
    assert got[None] == [(0, None, True)]
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_a_group_of_sixty_shards(spark):
    """All counts of a tight group are whole, copies included, though no search sees more than a few shards."""
    rng = np.random.default_rng(8)
    middle = rng.normal(size=16)
    data = np.concatenate([middle + 0.03 * rng.normal(size=(1_200, 16)), rng.normal(size=(40, 16))]).astype(np.float32)
    data[5] = data[700]
    ids = [int(i) for i in np.random.default_rng(2).permutation(len(data))]
    frame = spark.createDataFrame(list(zip(ids, data.tolist())), "vec_id long, embedding array<float>")
    count, root = brute(data, ids)
    assert min(count[i] for i in ids[:1_200]) > 1_100
    rows = vectors.near_vectors(frame, shard=20).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {i: (count[i], root[i]) for i in ids}


def test_blocks_of_a_large_component(spark):
    data = clouds(seed=6)
    unit = data.astype(np.float64)
    rows = [(i, 1 + i % 3, v.tolist(), i % 2) for i, v in enumerate(unit)]
    frame = spark.createDataFrame(rows, "node long, copies long, vector array<double>, component long")
    got = {r.node: r.exact for r in vectors.recounted(frame, 1, 0.95, block=17).collect()}
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    for i in range(len(unit)):
        others = [j for j in range(i % 2, len(unit), 2) if j != i and near[i, j]]
        assert got[i] == sum(1 + j % 3 for j in others)


def on_disk(folders):
    total = 0
    for folder in folders:
        for file in Path(folder).rglob("*"):
            try:
                total += file.stat().st_size if file.is_file() else 0
            except OSError:  # gone meanwhile
                pass
    return total


def test_disk_of_a_run(spark):
    """Shuffle files and intermediate tables take less than four times the vectors at any time."""
    rng = np.random.default_rng(3)
    groups = [c + 0.01 * rng.normal(size=(n, 64)) for n in [400] + 50 * [2] + 10 * [20] for c in rng.normal(size=(1, 64))]
    data = np.concatenate([rng.normal(size=(9_300, 64)), *groups]).astype(np.float32)
    ids = [int(i) for i in rng.permutation(len(data))]
    frame = spark.createDataFrame(list(zip(ids, data.tolist())), "vec_id long, embedding array<float>").repartition(4)
    local = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
    folders = [shared_folder(spark).removeprefix("file:"), *(str(d.getPath()) for d in local)]
    before, most, ended = on_disk(folders), 0, threading.Event()

    def watch():
        nonlocal most
        while not ended.wait(0.1):
            most = max(most, on_disk(folders))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame, shard=200).collect()}
    finally:
        ended.set()
        watcher.join()
    count, root = brute(data, ids)
    assert got == {i: (count[i], root[i]) for i in ids}
    assert 0 < most - before < 4 * data.nbytes


def test_the_session_keeps_its_settings(spark):
    before = [spark.conf.get(name, None) for name in CLEANUP]
    frame = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert vectors.near_vectors(frame).collect()[0].n_links == 0
    assert [spark.conf.get(name, None) for name in CLEANUP] == before


def test_equal_vectors_in_all_parts(spark):
    """Equal vectors are one node wherever their rows lie; zeros of either sign are equal."""
    rng = np.random.default_rng(9)
    data = np.repeat(rng.normal(size=(30, 8)).astype(np.float32), 40, axis=0)
    data[:, 3] = 0.0
    data[::2, 3] = -0.0
    ids = [int(i) for i in rng.permutation(len(data))]
    frame = spark.createDataFrame(list(zip(ids, data.tolist())), "vec_id long, embedding array<float>").repartition(7)
    count, root = brute(data, ids)
    for kind in ("float", "double"):
        rows = vectors.near_vectors(frame.selectExpr("vec_id", f"CAST(embedding AS array<{kind}>)"), shard=10).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {i: (count[i], root[i]) for i in ids}


def plainly_pruned(unit, candidates, alike):
    """The rule itself, for one node: up to DEGREE of its candidates, the nearest first."""
    alive = {int(c): a for c, a in zip(candidates, alike) if a > -2}
    order, chosen = sorted(alive, key=lambda c: -alive[c]), []
    few = {int(c) for c in candidates[np.argsort(-alike, kind="stable")][: vectors.NEAREST]}
    for c in order:
        near = [p for p in chosen if vectors.ALPHA * np.sqrt(2 - 2 * unit[p] @ unit[c]) <= np.sqrt(2 - 2 * alive[c])]
        if len(chosen) < vectors.DEGREE and (c in few or not near):
            chosen.append(c)
    return chosen


@pytest.mark.parametrize("spread", (0.05, 0.3, 1.0))
def test_pruning_by_the_rule(spread):
    rng = np.random.default_rng(2)
    unit = rng.normal(size=16) + spread * rng.normal(size=(400, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    alike = unit[:20] @ unit.T
    alike[np.arange(20), np.arange(20)] = -2
    candidates = np.stack([rng.permutation(400)[:128] for _ in range(20)])
    likes = np.take_along_axis(alike, candidates, 1)
    got = vectors.pruned(unit, candidates, likes)
    for i in range(20):
        assert [c for c in got[i] if c >= 0] == plainly_pruned(unit, candidates[i], likes[i])


def test_a_bundle_against_brute_force(monkeypatch):
    """Ends of a bundle of three shards, with nodes met by search and, in a crowd, by the whole bundle."""
    data = np.unique(clouds(seed=12), axis=0)
    unit = data.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = np.random.default_rng(5).permutation(len(data)).astype(np.int64)
    shards = np.stack([np.arange(len(data)) % 3, (np.arange(len(data)) + 1) % 3], axis=1).astype(np.int32)
    rows = pa.table({"vec_id": ids, "vector": list(data), "bundle": [0] * len(data), "shards": list(shards)})
    _, root = brute(data, ids.tolist())
    for full in (20, 10_000):
        monkeypatch.setattr(vectors, "FULL", full)
        ends = vectors.linked(rows, np.zeros(3, dtype=np.int32), 0.95)
        got = {i: i for i in ids.tolist()} | dict(zip(ends["node"].to_pylist(), ends["low"].to_pylist()))
        assert got == root


def test_bundles_are_parts_of_centres():
    middle = np.random.default_rng(1).normal(size=(101, 8))
    bundle = vectors.bundled(middle, 8)
    size = np.bincount(bundle)
    assert size.sum() == 101 and size.max() <= 8 and size.min() >= 3
    assert (vectors.bundled(middle[:8], 8) == 0).all()


def test_usable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0], [-1.0, 0.0], [0.0, 1e-300], [-0.0, 5.0]]
    bad = [None, [], [0.0], [-0.0, 0.0], [nan, 1.0], [1.0, inf], [-inf, 1.0], [None, 1.0], [1.0, None, inf], [None]]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(good + bad)], "i int, v array<double>")
    for kind in ("float", "double"):
        rows = frame.where("i <> 2 OR '%s' = 'double'" % kind).select("i", vectors.usable(frame["v"].cast(f"array<{kind}>")).alias("u"))
        assert all(r.u == (r.i < len(good)) for r in rows.collect())


def test_no_shard_holds_a_tight_group():
    """New members of a tight group are dealt to many shards, though one of its centres is the nearest to nearly all."""
    rng = np.random.default_rng(4)

    def some(n):
        x = np.concatenate([rng.normal(size=(n, 32)), 1 + 0.02 * rng.normal(size=(n // 10, 32))])
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    sample = some(2_000)
    middle = sample[rng.permutation(len(sample))[:400]]
    group = np.flatnonzero(middle.mean(axis=1) > 0.15)
    best = sample[2_000:].mean(axis=0)
    middle[group[0]] = best / np.linalg.norm(best)
    off, weight = vectors.levelled(sample, middle, 3)
    new = some(4_000)
    sizes = [
        np.bincount(np.argpartition(taken - new @ middle.T, 2, axis=1)[:, :3].ravel(), minlength=400) / (3 * len(new) / 400)
        for taken in (0, off)
    ]
    assert sizes[0].max() > 12 and sizes[1].max() < 8 and weight.max() < 4
    assert (vectors.levelled(sample, middle[:3], 3)[0] == 0).all()
