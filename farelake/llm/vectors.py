"""Near-duplicate vectors with a robust-pruned flat graph.

1. Equal vectors are one node with a number of copies; they are told by two 64-bit hashes of the vector.
2. `centres`: centres are fitted to a bounded sample, about one per `shard` nodes. Every node goes to
   the shards of its `overlap` nearest centres; centres of crowded shards fall back (`levelled`). Shards whose centres lie together are a bundle, which one
   task holds (`bundled`): a node is sent once to each bundle that has one of its shards.
3. `build`: each shard gives its nodes neighbours by robust pruning: of near and of random candidates,
   the nearest is taken, and all that are closer to it than to the node (by a factor) are passed over.
   The few nearest stay in any case, and links hold both ways. The lists of a node from all its
   shards in a bundle are united, so they lead across shards; lists never leave their task.
4. `search`: in every bundle, for every node that has anything in range (or just outside) in its shards,
   as `build` has seen, a greedy search over the united lists starts at the medoids
   of the shards and at the node itself, keeps the best of what it meets, and then expands: the
   neighbours of everything in range (or just outside) are looked at until nothing new is in range. Where
   very much is in range, the node is compared with the whole bundle instead.
5. What was found is verified by the cosine in double precision. Links leave a task only as links of each
   node to the smallest one it is connected with there; a node that lies in several bundles ties what they found.
6. The links of a node are counted block by block, over all pairs of its component, so counts are whole
   wherever the search met the other end. `recounted`: a component of more nodes than half a shard is dealt
   to blocks, and every block meets every other block of the component once, in a task of its own.
   `packed`: smaller components share blocks. Pairs of blocks move, never pairs of vectors.

Vectors move as the type they are given in (float or double): once per bundle, and those with links by their
hash and with their blocks. Elsewhere their hashes stand for them, and only vectors with links are written to
intermediate tables. Shuffle files of a step go as soon as its result is written.

`audit` measures the recall of links against brute force.

Cases: null vectors, empty ones, zero vectors and vectors with null or non-finite components link
with nothing; vectors of different lengths do not link; equal rows of one vec_id are one vector; rows
with a null vec_id link with nothing (component null, kept); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.llm.common import hand_back, narrowed, shipped, stored, tidy
from farelake.llm.components import components
from farelake.sources.scratch import shuffles_removed

#: Vectors to which the centres are fitted, at most.
SAMPLE = 20_000
DEGREE, NEAREST, NEAR, FAR = 32, 8, 64, 64
ALPHA = 1.2
BEAM = 24
#: How far below the threshold the range search still looks around.
SLACK = 0.05
#: Nodes that are searched for side by side, at most, and cosines that are held for them.
BLOCK, SCORES = 256, 1 << 23
#: Size of a shard over the average, at most, as far as the sample shows and so many rounds reach it.
UNEVEN, LEVELLING = 3, 24
#: Vectors that a task keeps in mind, so that equal ones are not sent again.
RECENT = 100_000
#: A bundle has the nodes of BUNDLE usual shards and so many bytes, about, and there are SPREAD bundles at least.
BUNDLE, SPREAD, BUNDLE_BYTES = 8, 12, 16 << 20
#: In range of a node, from which on it is compared with the whole bundle.
FULL = 512
#: Nodes of a block of a large component, at least; blocks of a component, until a block has so many bytes.
MEET, PARTS, MEET_BYTES = 2_048, 16, 32 << 20


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not all of them zero.

    `array_contains` is null beside a null component, and NaN is greater than any number.
    """
    most, least, endless = F.array_max(vector), F.array_min(vector), float("inf")
    finite = ~F.array_contains(vector, F.lit(endless).cast("double")) & (most < endless) & (least > -endless)
    return F.coalesce((F.size(vector) > 0) & finite & ((most != 0) | (least != 0)), F.lit(False))


def units(raw: np.ndarray) -> np.ndarray:
    """The rows as unit vectors in double precision. Scaled first, so that no square overflows."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True).astype(np.float64)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def matrix(vectors: pd.Series) -> np.ndarray:
    """Unit vectors of a column, one row each."""
    return units(np.array(vectors.tolist(), dtype=np.float64))


def rectangle(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of an array, in their own type."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def centres(rows: DataFrame, total: int, shard: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres, about one per `shard` of `total` nodes, by a few rounds of k-means on a bounded sample of them.

    The sample comes with them.
    """
    count = max(1, min(-(-total // shard), SAMPLE // 4))
    share = min(1.0, SAMPLE / max(total, 1))
    picked = rows.where(F.pmod("hi", F.lit(1 << 20)) < int(share * (1 << 20))).dropDuplicates(["hi", "lo"])
    sample = units(rectangle(picked.limit(2 * SAMPLE).select("vector").toArrow()["vector"]))
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(8):
        nearest = np.concatenate([(sample[at : at + 1000] @ found.T).argmax(axis=1) for at in range(0, len(sample), 1000)])
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 0, sums / np.maximum(length, 1e-12), found)
    return found, sample


def levelled(sample: np.ndarray, middle: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """What to take off the cosines with each centre, and its weight then: the shard's size, 1 on average.

    In a tight group the centre of most samples is the nearest one to all, and its shard would hold the group.
    It falls back until UNEVEN times its share is left, the members nearest to a change leaving first.
    """
    size, single = len(middle), middle.astype(np.float32)
    off, share = np.zeros(size, dtype=np.float32), overlap * len(sample) / len(middle)
    if size <= overlap:
        return off, np.ones(size)
    most = max(overlap, int(UNEVEN * share))
    for step in range(LEVELLING + 1):
        members, margins = [], []
        for at in range(0, len(sample), 1000):
            score = sample[at : at + 1000].astype(np.float32) @ single.T - off
            top = np.argpartition(-score, overlap, axis=1)[:, : overlap + 1]
            likes = np.take_along_axis(score, top, 1)
            members.append(top[:, :overlap])
            margins.append(likes[:, :overlap] - likes[:, overlap:])
        member, margin = np.concatenate(members).ravel(), np.concatenate(margins).ravel()
        count = np.bincount(member, minlength=size)
        over = np.flatnonzero(count > most)
        if step == LEVELLING or not len(over):
            return off, count / share
        for centre in over:
            own = np.sort(margin[member == centre])
            off[centre] += own[len(own) - most - 1] + 1e-7


def bundled(middle: np.ndarray, most: float, weight: np.ndarray | None = None) -> np.ndarray:
    """The bundle of each centre: halved along their widest direction until a part weighs `most` at most."""
    weight = np.ones(len(middle)) if weight is None else weight
    bundle, waiting, done = np.zeros(len(middle), dtype=np.int32), [np.arange(len(middle))], 0
    while waiting:
        part = waiting.pop()
        if len(part) == 1 or weight[part].sum() <= most:
            bundle[part], done = done, done + 1
            continue
        about = middle[part] - middle[part].mean(axis=0)
        _, axes = np.linalg.eigh(about.T @ about)
        order = part[np.argsort(about @ axes[:, -1], kind="stable")]
        waiting += [order[: len(order) // 2], order[len(order) // 2 :]]
    return bundle


def dealt(rows: DataFrame, middle: np.ndarray, off: np.ndarray, bundle: np.ndarray, overlap: int) -> DataFrame:
    """A row per vector and bundle; `shards` are those of the vector, in whatever bundle.

    Of equal vectors near each other in the table, one of a smallest vec_id goes on.
    """
    width, single = min(overlap, len(middle)), middle.astype(np.float32)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[tuple[int, int], int] = {}
        for batch in batches:
            fresh = []
            ids, *keys = (batch[name].to_pylist() for name in ("vec_id", "hi", "lo"))
            for at, (vec_id, key) in enumerate(zip(ids, zip(*keys))):
                if told.get(key, vec_id + 1) > vec_id:
                    told[key] = vec_id
                    fresh.append(at)
            if len(told) > RECENT:
                told.clear()
            if fresh:
                alike = units(rectangle(batch["vector"])[fresh]).astype(np.float32) @ single.T - off
                near = np.argpartition(-alike, width - 1, axis=1)[:, :width].astype(np.int32)
                to = np.sort(bundle[near], axis=1)
                row, k = np.nonzero(np.c_[np.ones(len(to), dtype=bool), to[:, 1:] != to[:, :-1]])
                sent = batch.select(["vec_id", "vector"]).take(pa.array(np.array(fresh)[row]))
                ends = pa.array(np.arange(len(row) + 1, dtype=np.int32) * width)
                shards = pa.ListArray.from_arrays(ends, pa.array(near[row].ravel()))
                yield sent.append_column("bundle", pa.array(to[row, k])).append_column("shards", shards)

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"vec_id long, vector {kind}, bundle int, shards array<int>"
    return rows.select("vec_id", "hi", "lo", "vector").mapInArrow(tidy(assign), schema)


def pruned(unit: np.ndarray, candidates: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Robust pruning of the candidates of some nodes (a row each, with cosines; -2 is none): up to DEGREE, or -1."""
    order = np.argsort(-alike, axis=1)
    candidates, alike = np.take_along_axis(candidates, order, 1).astype(np.int32), np.take_along_axis(alike, order, 1)
    chosen = np.full((len(alike), DEGREE), -1)
    # What is taken depends on nearer ones only, so most rows are full before the far ones come.
    todo = np.arange(len(alike))
    for width in (DEGREE + NEAREST, 2 * DEGREE, candidates.shape[1]):
        near, likes = candidates[todo, :width], alike[todo, :width]
        kept = unit[near]
        # Squares of the distances, halved: passed over where ALPHA**2 * (1 - between) <= 1 - away.
        stays = kept @ kept.transpose(0, 2, 1) < (1 - (1 - likes) / ALPHA**2)[:, None, :]
        stays[:, :, :NEAREST] = True
        stays &= near[:, :, None] != near[:, None, :]
        alive, count = likes > -2, np.zeros(len(todo), dtype=int)
        chosen[todo] = -1
        for k in range(near.shape[1]):
            has = np.flatnonzero(alive[:, k] & (count < DEGREE))
            chosen[todo[has], count[has]] = near[has, k]
            count[has] += 1
            alive[has] &= stays[has, k]
        todo = todo[count < DEGREE]
        if not len(todo):
            break
    return chosen


def build(unit: np.ndarray, seed: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (src, dst) of one shard, both ways, and how many other nodes are within `least` of each node."""
    n = len(unit)
    if n < 2:
        return np.zeros((0, 2), dtype=np.int64), np.zeros(n, dtype=np.int64)
    rng = np.random.default_rng(seed)
    width, links, crowd = min(NEAR, n - 1), [], []
    block = max(16, min(BLOCK, SCORES // n))
    for at in range(0, n, block):
        own = np.arange(at, min(at + block, n))
        alike = unit[own] @ unit.T
        alike[np.arange(len(own)), own] = -2
        near = np.argpartition(alike, n - width, axis=1)[:, n - width :]
        candidates = np.concatenate([near, rng.integers(0, n, (len(own), FAR))], axis=1)
        chosen = pruned(unit, candidates, np.take_along_axis(alike, candidates, 1))
        at_row, k = np.nonzero(chosen >= 0)
        links.append(np.stack([own[at_row], chosen[at_row, k]], axis=1))
        crowd.append(np.count_nonzero(alike >= least, axis=1))
    one_way = np.concatenate(links)
    return np.concatenate([one_way, one_way[:, ::-1]]), np.concatenate(crowd)


class Lists:
    """United lists of links (src * n + dst) of n nodes: those of node i are `to[first[i] : first[i + 1]]`."""

    def __init__(self, links: list[np.ndarray], n: int) -> None:
        pairs = np.sort(np.concatenate(links))
        if len(pairs):
            pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
        self.to = (pairs % n).astype(np.int32)
        self.first = np.searchsorted(pairs, np.arange(n + 1) * np.int64(n))

    def of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of `nodes`, how manyeth, neighbour), a row per link."""
        first = self.first[nodes]
        count = self.first[nodes + 1] - first
        by = np.repeat(np.arange(len(nodes)), count)
        nth = np.arange(len(by)) - np.repeat(np.cumsum(count) - count, count)
        return by, nth, self.to[first[by] + nth]


def likeness(unit: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of pairs, some thousand at a time."""
    out = np.empty(len(a), dtype=unit.dtype)
    for at in range(0, len(a), 20_000):
        part = slice(at, at + 20_000)
        out[part] = np.einsum("pd,pd->p", unit[a[part]], unit[b[part]])
    return out


def greedy(unit: np.ndarray, lists: Lists, asked: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Greedy search for the nodes `asked`, all in step: the cosines of each with what it has met, -3 elsewhere."""
    row = np.arange(len(asked))
    score = np.full((len(asked), len(unit)), -3, dtype=unit.dtype)
    score[:, entries] = unit[asked] @ unit[entries].T
    score[row, asked] = 1
    best = np.concatenate([np.tile(entries, (len(asked), 1)), asked[:, None]], axis=1)
    alike = score[row[:, None], best]
    opened = np.zeros(best.shape, dtype=bool)
    opened[:, :-1] |= entries == asked[:, None]
    for _ in range(4 * BEAM):
        waiting = np.where(opened, -3, alike)
        pick = waiting.argmax(axis=1)
        go = np.flatnonzero(waiting[row, pick] > -3)
        if not len(go):
            break
        opened[go, pick[go]] = True
        by, _, met = lists.of(best[go, pick[go]])
        by = go[by]
        fresh = score[by, met] == -3
        by, met = by[fresh], met[fresh]
        score[by, met] = found = likeness(unit, met, asked[by])
        count = np.bincount(by, minlength=len(asked))
        nth = np.arange(len(by)) - np.repeat(np.cumsum(count) - count, count)
        shape = (len(asked), count.max(initial=0))
        new, new_alike, new_opened = np.zeros(shape, dtype=best.dtype), np.full(shape, -3, dtype=unit.dtype), np.ones(shape, dtype=bool)
        new[by, nth], new_alike[by, nth], new_opened[by, nth] = met, found, False
        best, alike, opened = (np.concatenate(x, axis=1) for x in ((best, new), (alike, new_alike), (opened, new_opened)))
        width = min(BEAM, best.shape[1])
        top = np.argpartition(-alike, width - 1, axis=1)[:, :width]
        best, alike, opened = best[row[:, None], top], alike[row[:, None], top], opened[row[:, None], top]
    return score


def expanded(unit: np.ndarray, lists: Lists, asked: np.ndarray, score: np.ndarray, least: float) -> None:
    """Fills in the scores of everything within `least` that is reached through nodes within it."""
    query, node = np.nonzero(score >= least)
    met_by = np.zeros(len(asked), dtype=np.int64)
    while len(query):
        met_by += np.bincount(query, minlength=len(asked))
        full = np.flatnonzero(met_by >= FULL)
        if len(full):
            score[full] = unit[asked[full]] @ unit.T
            met_by[full] = np.iinfo(np.int64).min // 2
        going = met_by[query] >= 0
        query, node = query[going], node[going]
        fresh = []
        for at in range(0, len(query), 20_000):
            by, _, met = lists.of(node[at : at + 20_000])
            by = query[at : at + 20_000][by]
            new = score[by, met] == -3
            pair = np.unique(by[new].astype(np.int64) * len(unit) + met[new])
            by, met = pair // len(unit), pair % len(unit)
            score[by, met] = alike = likeness(unit, met, asked[by])
            fresh.append(pair[alike >= least])
        pairs = np.concatenate(fresh) if fresh else np.zeros(0, dtype=np.int64)
        query, node = pairs // len(unit), pairs % len(unit)


def tied(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node each node is connected with, once the links a - b have come to those before."""
    while True:
        one, other = root[a], root[b]
        apart = one != other
        if not apart.any():
            return root
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        to = np.arange(len(root))
        np.minimum.at(to, np.maximum(one, other), np.minimum(one, other))
        while (to[to] != to).any():
            to = to[to]
        root = to[root]


def search(exact: np.ndarray, lists: Lists, entries: np.ndarray, crowd: np.ndarray, threshold: float) -> np.ndarray:
    """For each node of a bundle the first one that links found here connect it with.

    `crowd` is how many nodes are in range or just outside in a shard of the node: without any there is no
    search, with FULL of them the node is compared with the whole bundle.
    The graph is searched in single precision; cosines that this leaves in doubt are taken in double.
    """
    unit = exact.astype(np.float32)
    doubt = (exact.shape[1] + 8) * 2.0**-23
    root = np.arange(len(exact))
    block, few = max(16, min(BLOCK, SCORES // len(exact))), max(1, SCORES // 16 // len(exact))
    full, some = np.flatnonzero(crowd >= FULL), np.flatnonzero((crowd > 0) & (crowd < FULL))
    for asked in [x[at : at + block] for x in (full, some) for at in range(0, len(x), block)]:
        if crowd[asked[0]] >= FULL:
            score = unit[asked] @ unit.T
        else:
            score = greedy(unit, lists, asked, entries)
            expanded(unit, lists, asked, score, threshold - SLACK)
        for part in range(0, len(asked), few):
            own, alike = asked[part : part + few], score[part : part + few]
            # Links between nodes that are connected already, and of a node with itself, tell nothing new.
            query, node = np.nonzero((alike >= threshold - doubt) & (root[own][:, None] != root))
            sure = alike[query, node] >= threshold + doubt
            sure[~sure] = likeness(exact, node[~sure], own[query[~sure]]) >= threshold
            root = tied(root, own[query[sure]], node[sure])
    return root


def linked(rows: pa.Table, bundle: np.ndarray, threshold: float) -> pa.Table:
    """(node, low): each node of a bundle with the smallest one that it is connected with there, if another."""
    ids, given = rows["vec_id"].to_numpy(), rectangle(rows["vector"]) + 0.0
    order = np.argsort(ids, kind="stable")
    # Equal vectors have the same shards, so all of them are here (zeros of either sign are equal).
    order = order[~pd.Series([x.tobytes() for x in given[order]]).duplicated().to_numpy()]
    exact, node, n = units(given[order]), ids[order], len(order)
    unit, shards = exact.astype(np.float32), rectangle(rows["shards"])[order]
    links, entries, crowd = [], [], np.zeros(n, dtype=np.int64)
    for shard in np.flatnonzero(bundle == rows["bundle"][0].as_py()):
        core = np.flatnonzero((shards == shard).any(axis=1))
        if len(core):
            pairs, within = build(unit[core], int(shard), threshold - SLACK)
            links.append(core[pairs[:, 0]] * n + core[pairs[:, 1]])
            crowd[core] = np.maximum(crowd[core], within)
            # The node in the middle of the shard, and some in its outskirts, which it may not lead to.
            middle = core[(unit[core] @ unit[core].mean(axis=0)).argmax()]
            entries.append(np.r_[middle, core[:: max(1, len(core) // 8)]])
    low = node[search(exact, Lists(links, n), np.unique(np.concatenate(entries)), crowd, threshold)]
    return pa.table({"node": node[low < node], "low": low[low < node]})


def of_length(rows: DataFrame, size: int, total: int, threshold: float, shard: int, overlap: int) -> DataFrame:
    """(node, low) for rows whose vectors all have `size` components, `total` different ones."""
    middle, sample = centres(rows, total, shard)
    off, weight = levelled(sample, middle, overlap)
    home = max(1, total // len(middle))
    most = min(BUNDLE * shard // home, BUNDLE_BYTES // (4 * size * home), len(middle) // SPREAD)
    bundle = bundled(middle, max(1, most), weight)

    def run(held: pa.Table) -> pa.Table:
        ends = linked(held, bundle, threshold)
        hand_back()
        return ends

    return dealt(rows, middle, off, bundle, overlap).groupBy("bundle").applyInArrow(run, "node long, low long")


def met(left: pd.DataFrame, right: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(node, found): the links between two blocks, or inside one, counted for the nodes of both."""
    if not len(left) or not len(right):
        return pd.DataFrame({"node": np.zeros(0, np.int64), "found": np.zeros(0, np.int64)})
    a, b = left["node"].to_numpy(), right["node"].to_numpy()
    ours, theirs = left["copies"].to_numpy(), right["copies"].to_numpy()
    own = bool(left["i"].iloc[0] == left["j"].iloc[0])
    group_a, group_b = left["component"].to_numpy(), right["component"].to_numpy()
    one, other = matrix(left["vector"]), matrix(right["vector"])
    found_a, found_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
    step = max(1, (1 << 20) // len(b))
    for at in range(0, len(a), step):
        near = one[at : at + step] @ other.T >= threshold
        near &= (a[at : at + step, None] != b) & (group_a[at : at + step, None] == group_b)
        found_a[at : at + step] = near @ theirs
        if not own:
            found_b += ours[at : at + step] @ near
    if own:
        return pd.DataFrame({"node": a, "found": found_a})
    return pd.DataFrame({"node": np.r_[a, b], "found": np.r_[found_a, found_b]})


def recounted(nodes: DataFrame, least: int, threshold: float, block: int = MEET) -> DataFrame:
    """(node, exact): links of the nodes in components of more than `least` nodes, block by block.

    `nodes` has a component for every node; there are no links between components, nor between lengths.
    """
    size = F.size("vector")
    room = F.greatest(F.lit(block), F.least(F.ceil(F.col("n") / PARTS), F.ceil(F.lit(MEET_BYTES) / (8 * size))))
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    parts = F.ceil(F.col("n") / room).cast("int")
    large = nodes.join(sizes, "component").withColumn("size", size).withColumn("parts", parts).drop("n")
    dealt = stored(large.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")), "large")
    columns = ["component", "size", "i", "j", "node", "copies", "vector"]
    left = dealt.withColumn("i", F.col("part")).withColumn("j", F.explode(F.sequence("part", F.col("parts") - 1)))
    right = dealt.withColumn("j", F.col("part")).withColumn("i", F.explode(F.sequence(F.lit(0), "part")))

    def run(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        return met(one, other, threshold)

    by = ["component", "size", "i", "j"]
    pairs = left.select(columns).groupBy(by).cogroup(right.select(columns).groupBy(by))
    counted = pairs.applyInPandas(run, "node long, found long")
    return counted.groupBy("node").agg(F.sum("found").alias("exact"))


def packed(nodes: DataFrame, least: int, threshold: float, block: int = MEET) -> DataFrame:
    """(node, exact): links of the nodes in components of `least` nodes at most; many components share a block.

    `nodes` as in `recounted`.
    """
    sizes = nodes.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= least)
    blocks = -(-(sizes.agg(F.sum("n")).first()[0] or 0) // block)
    pack = F.pmod(F.xxhash64("component"), F.lit(max(1, blocks))).cast("int")
    small = nodes.join(sizes.select("component"), "component").withColumn("i", pack).withColumn("j", F.col("i"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return met(frame, frame, threshold)

    columns = ["component", F.size("vector").alias("size"), "i", "j", "node", "copies", "vector"]
    counted = small.select(columns).groupBy("i", "size").applyInPandas(run, "node long, found long")
    return counted.groupBy("node").agg(F.sum("found").alias("exact"))


def near_vectors(vectors: DataFrame, threshold: float = 0.95, shard: int = 1500, overlap: int = 3) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable) and kept, one row per row of `vectors`."""
    shipped(vectors.sparkSession)
    with shuffles_removed(vectors.sparkSession):
        return found(vectors, threshold, shard, overlap)


def found(vectors: DataFrame, threshold: float, shard: int, overlap: int) -> DataFrame:
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType())
    vector = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = vectors.select("vec_id", vector.alias("vector"))
    rows = rows.withColumn("hi", F.xxhash64("vector")).withColumn("lo", F.xxhash64(F.lit(1), "vector"))
    good = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("size", F.size("vector"))
    names = good.groupBy("hi", "lo", "size").agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("copies"))
    names = stored(names, "names")
    lengths = sorted((row["size"], row["n"]) for row in names.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect())
    results = [of_length(good.where(F.col("size") == size), size, n, threshold, shard, overlap) for size, n in lengths]
    if not results:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    ends = results[0]
    for other in results[1:]:
        ends = ends.union(other)
    joined = stored(components(stored(ends, "ends"), "node", "low"), "joined")
    members = joined.union(joined.select("component", "component").distinct())
    inside = stored(names.join(members, "node").select("hi", "lo", "node", "copies", "component"), "inside")
    held = narrowed(good.select(F.col("hi").alias("doc_id"), "lo", "vector"), inside, "hi").withColumnRenamed("doc_id", "hi")
    held = held.groupBy("hi", "lo").agg(F.first("vector").alias("vector"))
    grouped = stored(inside.join(held, ["hi", "lo"]).select("node", "copies", "component", "vector"), "grouped")
    least = shard // 2
    counts = stored(recounted(grouped, least, threshold).union(packed(grouped, least, threshold)), "counts")
    links = F.col("copies") - 1 + F.coalesce("exact", F.lit(0))
    class_ = (
        names.join(members, "node", "left")
        .join(counts, "node", "left")
        .select("hi", "lo", links.alias("links"), F.coalesce("component", "node").alias("component"))
    )
    known = rows.select("vec_id", "hi", "lo", (usable(F.col("vector")) & F.col("vec_id").isNotNull()).alias("usable"))
    matched = known.join(class_, ["hi", "lo"], "left")
    component = F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id"))
    return matched.select(
        "vec_id",
        F.when(F.col("usable"), F.col("links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def audit(vectors: DataFrame, result: DataFrame, threshold: float = 0.95, every: int = 50, block: int = 512) -> float:
    """Share of the links of every `every`-th vector that `result` has, against brute force.

    The asked vectors meet all rows in blocks; only the counts per asked vector are kept.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()

    def blocks(frame: DataFrame, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, frame.count() // block)))
        return frame.groupBy(number.alias(name), F.size("vector").alias("length")).agg(
            F.collect_list(F.struct("vec_id", "vector")).alias(f"{name}_rows")
        )

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for asked, others in zip(frame["asked_rows"], frame["other_rows"]):
                ids = np.array([r["vec_id"] for r in asked])
                unit, theirs = (matrix(pd.Series([r["vector"] for r in x])) for x in (asked, others))
                same = ids[:, None] == np.array([r["vec_id"] for r in others])
                yield pd.DataFrame({"vec_id": ids, "n": ((unit @ theirs.T >= threshold) & ~same).sum(axis=1)})

    asked = blocks(rows.where(f"vec_id % {every} = 0"), "asked")
    truth = asked.join(blocks(rows, "other"), "length").select("asked_rows", "other_rows")
    truth = truth.mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    have = truth.join(result.select("vec_id", "n_links").distinct(), "vec_id")
    total, found = have.agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
    return found / total if total else 1.0
