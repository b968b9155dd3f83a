"""Repeated passages by prefix-partitioned suffix trees over words.

A suffix starts at a word and is cut after `size` words: what lies deeper does not change which
passages of `size` words repeat. Its path in the tree has four edges, each the hash of a quarter of
those words. The tree is never in one place:

1. Equal texts are found first; all but the one with the smallest doc_id are repeats as a whole.
2. `anchors`: a window of `size` words is named by the smallest hash among its short word runs, so
   equal windows have equal anchors. A suffix can only repeat if its anchor occurs twice; the others
   are left out of the tree. A task that meets an anchor twice needs nobody else to know that it
   repeats, and tells the others by two rows, of its smallest and its largest text name.
3. `suffixes`: each task first merges its own suffixes. Of equal ones the earliest goes on, the others
   are repeats already; so a passage that a third of all documents share is one row per task.
4. Suffixes are grouped by a prefix of their path. A prefix is one edge long; where a fixed-size table
   of counts shows that this makes a group larger than a task should hold, it is two, three or four
   edges long.
5. `subtrees`: a group sorted by path is its subtree, leaves in order. The depth at which neighbours
   part gives the internal nodes; below a node of full depth, every leaf but the earliest is a repeat.
6. The words that repeated windows cover are removed.

Cases: null text has no words; texts shorter than a window keep all words; rows of one doc_id are one
document; rows with a null doc_id neither lose words nor make others lose them; an empty table gives
an empty result; other columns are ignored by `repeats`; texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.common import hand_back, shipped, stored, tidy
from farelake.llm.shingles import mixed, window_hashes, word_hashes

EDGES = 4
#: Words of an anchor.
ANCHOR = 6
#: Suffixes that a group should not exceed, and the cells of the table that counts them.
GROUP = 1_000_000
CELLS = 1 << 16


def smallest_runs(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The short word runs' hashes, and for every window the place of its smallest one."""
    runs = window_hashes(words, min(ANCHOR, size))
    width = size - min(ANCHOR, size) + 1
    if len(runs) < width:
        return runs, np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(runs, width)
    return runs, views.argmin(axis=1) + np.arange(len(views))


def paths(words: np.ndarray, size: int) -> np.ndarray:
    """Two 64-bit numbers per window: the hashes of its four edges, 32 bits each."""
    step = -(-size // EDGES)
    edge = window_hashes(words, min(step, size)) >> np.uint64(32)
    n = len(words) - size + 1
    parts = [edge[start : start + n] for start in (min(k * step, size - min(step, size)) for k in range(EDGES))]
    high = np.uint64(32)
    return np.stack([parts[0] << high | parts[1], parts[2] << high | parts[3]], axis=1).view(np.int64)


def copies(docs: DataFrame) -> DataFrame:
    """doc_id of every document whose text a smaller doc_id has as well."""
    named = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.unhex(F.md5("text")).alias("name"))
    classes = named.groupBy("name").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    return named.join(classes.where("rep < last"), "name").where("doc_id > rep").select("doc_id").distinct()


def anchors(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, anchor): the anchors of each document that occur elsewhere as well, or twice in it."""

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, ids, names, seen = [], [], [], set()
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                name = xxhash.xxh64_intdigest(text) - (1 << 63)
                if (doc_id, name) in seen:
                    continue
                seen.add((doc_id, name))
                runs, place = smallest_runs(word_hashes(text), size)
                if len(place):
                    found.append(runs[np.unique(place)].view(np.int64))
                    ids.append(np.full(len(found[-1]), doc_id))
                    names.append(np.full(len(found[-1]), name))
        if not found:
            return
        anchor, doc_id, name = map(np.concatenate, (found, ids, names))
        order = np.lexsort((doc_id, name, anchor))
        anchor, doc_id, name = anchor[order], doc_id[order], name[order]
        start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        sizes = np.diff(np.r_[start, len(anchor)])
        # Met under two names, or twice in one document.
        again = np.zeros(len(anchor), dtype=bool)
        again[1:] = (anchor[1:] == anchor[:-1]) & ((name[1:] != name[:-1]) | (doc_id[1:] == doc_id[:-1]))
        known = np.repeat(np.logical_or.reduceat(again, start), sizes)
        # Where it is known here, the smallest and the largest name ask: whatever name another task has,
        # one of the two differs from it. Elsewhere all rows of the anchor have one name, and all ask.
        last = start + sizes - 1
        ends = np.zeros(len(anchor), dtype=bool)
        ends[start] = True
        ends[last] |= name[last] != name[start]
        asks = pd.DataFrame({"route": anchor, "anchor": anchor, "doc_id": doc_id, "name": name, "known": False})
        yield asks[~known | ends]
        told = pd.DataFrame({"route": doc_id, "anchor": anchor, "doc_id": doc_id, "name": name, "known": True})
        yield told[known].drop_duplicates(["anchor", "doc_id"])

    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    rows = texts.mapInPandas(tidy(gather), "route long, anchor long, doc_id long, name long, known boolean")
    met = "OVER (PARTITION BY route, anchor, known)"
    return (
        rows.selectExpr("doc_id", "anchor", "known", f"min(name) {met} < max(name) {met} AS met")
        .where("known OR met")
        .select("doc_id", "anchor")
    )


def suffixes(texts: DataFrame, repeated: DataFrame, size: int, full: list[set[int]]) -> DataFrame:
    """(doc_id, start, length, path1, path2, depth): suffixes for the tree; without a path, known repeats.

    A suffix has the start of its window and the number of edges, less one, of the prefix by which it
    is dealt; known repeats are runs of `length` window starts.
    """
    listed = [np.array(sorted(f), dtype=np.uint64) for f in full[: EDGES - 1]]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, starts, ways = [], [], []
        for frame in frames:
            for doc_id, text, marks in zip(frame["doc_id"], frame["text"], frame["anchors"]):
                words = word_hashes(text)
                runs, place = smallest_runs(words, size)
                start = np.flatnonzero(np.isin(runs.view(np.int64)[place], np.asarray(marks, dtype=np.int64)))
                if len(start):
                    ids.append(np.full(len(start), doc_id))
                    starts.append(start)
                    ways.append(paths(words, size)[start])
        if not ids:
            return
        doc_id, start, way = map(np.concatenate, (ids, starts, ways))
        order = np.lexsort((start, doc_id, way[:, 1], way[:, 0]))
        doc_id, start, way = doc_id[order], start[order], way[order]
        same = np.r_[False, (way[1:] == way[:-1]).all(axis=1)]
        twin = np.r_[False, (doc_id[1:] == doc_id[:-1]) & (start[1:] == start[:-1])] & same
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        later = same & ~((doc_id == doc_id[first]) & (start == start[first])) & ~twin
        way, depth = way[~same], np.zeros((~same).sum(), dtype=np.int8)
        for level, cell in enumerate(cells(way)):
            depth[(depth == level) & np.isin(cell, listed[level])] = level + 1
        out = pd.DataFrame({"doc_id": doc_id[~same], "start": start[~same], "length": 1})
        yield out.assign(path1=way[:, 0], path2=way[:, 1], depth=depth)
        yield as_runs(doc_id[later], start[later]).assign(path1=None, path2=None, depth=0)

    marked = repeated.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    return (
        texts.join(marked, "doc_id")
        .select("doc_id", "text", "anchors")
        .mapInPandas(tidy(cut), "doc_id long, start int, length int, path1 long, path2 long, depth byte")
    )


def as_runs(doc_id: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Window starts as runs of consecutive ones."""
    order = np.lexsort((start, doc_id))
    doc_id, start = doc_id[order], start[order]
    new = np.r_[True, (doc_id[1:] != doc_id[:-1]) | (start[1:] > start[:-1] + 1)][: len(doc_id)]
    place = np.flatnonzero(new)
    last = np.r_[place[1:], len(doc_id)][: len(place)] - 1
    return pd.DataFrame(
        {"doc_id": doc_id[place], "start": start[place], "length": start[last] - start[place] + 1}
    )


def prefix(depth: int) -> Column:
    """The first edges of a path as one number."""
    high = F.shiftright("path2", 32)
    return [F.shiftright("path1", 32), F.col("path1"), F.xxhash64("path1", high), F.xxhash64("path1", "path2")][depth]


def cells(way: np.ndarray) -> np.ndarray:
    """The cell of the table of counts for the prefixes of one, two and three edges of each path."""
    first, second = way.view(np.uint64).T
    high = np.uint64(32)
    keys = [first >> high, first, mixed(first) ^ (second >> high)]
    return np.stack([mixed(k) & np.uint64(CELLS - 1) for k in keys])


def full_cells(docs: DataFrame, size: int, group: int) -> list[set[int]]:
    """Cells, per depth, of prefixes that more than `group` windows and much more than usual share.

    The table has a fixed number of cells; one sums all prefixes that hash to it, so it never shows
    less than the size of a group. Only the cells that stand out, at most a sixteenth, come back.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((EDGES - 1, CELLS), dtype=np.int64)
        for frame in frames:
            for text in frame["text"]:
                words = word_hashes(text)
                if len(words) >= size:
                    for depth, cell in enumerate(cells(paths(words, size))):
                        table[depth] += np.bincount(cell.view(np.int64), minlength=CELLS)
        depth, cell = np.nonzero(table)
        yield pd.DataFrame({"depth": depth, "cell": cell, "n": table[depth, cell]})

    counts = (
        docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
        .select("text")
        .mapInPandas(tidy(count), "depth int, cell int, n long")
        .groupBy("depth", "cell")
        .agg(F.sum("n").alias("n"))
    )
    usual = F.sum("n").over(Window.partitionBy("depth")) / CELLS
    heavy = counts.select("depth", "cell", "n", usual.alias("usual")).where(f"n > {group} AND n > 16 * usual")
    full: list[set[int]] = [set() for _ in range(EDGES)]
    for row in heavy.select("depth", "cell").collect():
        full[row.depth].add(row.cell)
    return full


def grouped(tree: DataFrame) -> DataFrame:
    """The suffixes dealt by prefix and sorted by path; known repeats go anywhere."""
    route = F.xxhash64("depth", prefix(EDGES - 1))
    for depth in range(EDGES - 1):
        route = F.when(F.col("depth") == depth, F.xxhash64("depth", prefix(depth))).otherwise(route)
    route = F.when(F.col("path1").isNotNull(), route).otherwise(F.xxhash64("doc_id", "start"))
    return (
        tree.repartition(route)
        .select("doc_id", "start", "length", "path1", "path2")
        .sortWithinPartitions("path1", "path2", "doc_id", "start")
    )


def subtrees(groups: DataFrame) -> DataFrame:
    """(doc_id, start, length) of repeated windows: leaves below nodes of full depth, but the earliest.

    Leaves come in order; only the leaf at hand and the earliest one below its node are kept.
    """

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Path, doc_id and start of the earliest leaf below the last node.
        before = None
        for frame in frames:
            told = frame["path1"].isna().to_numpy()
            if told.any():
                yield frame.loc[told, ["doc_id", "start", "length"]]
                frame = frame[~told]
            if not len(frame):
                continue
            way = frame[["path1", "path2"]].to_numpy(dtype=np.int64)
            leaf = frame[["doc_id", "start"]].to_numpy(dtype=np.int64)
            node = np.r_[True, (way[1:] != way[:-1]).any(axis=1)]
            if before is not None:
                node[0] = (way[0] != before[0]).any()
            first = np.maximum.accumulate(np.where(node, np.arange(len(node)), -1))
            earliest = np.where((first >= 0)[:, None], leaf[np.maximum(first, 0)], before[1] if before else 0)
            later = ~node & (leaf != earliest).any(axis=1)
            yield as_runs(leaf[later, 0], leaf[later, 1])
            before = way[-1], earliest[-1]

    return groups.mapInPandas(tidy(walk), "doc_id long, start int, length int")


def removals(texts: DataFrame, size: int, group: int = GROUP) -> DataFrame:
    """doc_id, `copy` (the whole text is one of an earlier document) and `runs` of repeated window starts.

    Documents without either are left out.
    """
    shipped(texts.sparkSession)
    known = stored(copies(texts), "copies")
    repeated = stored(anchors(texts, size).join(known, "doc_id", "left_anti"), "anchors")
    tree = suffixes(texts, repeated, size, full_cells(texts, size, group))
    found = subtrees(grouped(tree)).groupBy("doc_id").agg(F.collect_list(F.struct("start", "length")).alias("runs"))
    return found.join(known.select("doc_id", F.lit(True).alias("copy")), "doc_id", "full")


def kept_words(words: list, copy: bool | None, runs, size: int) -> tuple[list, int]:
    """The words that stay, and how many go."""
    if copy and len(words) >= size:
        return [], len(words)
    if runs is None or not len(runs):
        return words, 0
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for run in runs:
        edge[run["start"]] += 1
        edge[min(run["start"] + run["length"] - 1 + size, len(words))] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone) if not g], int(gone.sum())


def without_repeats(docs: DataFrame, size: int = 20, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed and `kept`, the words that stay joined by a space; a row per row."""

    def remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, text, copy, runs in zip(frame["doc_id"], frame["text"], frame["copy"], frame["runs"]):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                stay, gone = kept_words(words, copy is True or copy is np.True_, runs, size)
                rows.append((doc_id, len(words), gone, b" ".join(stay).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept"])

    # The texts are shuffled by doc_id once; both joins with them read that shuffle.
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    flagged = texts.join(removals(texts, size, group), "doc_id", "left").select("doc_id", "text", "copy", "runs")
    nameless = docs.where("doc_id IS NULL").selectExpr(
        "doc_id", "text", "CAST(NULL AS boolean) AS copy", "CAST(NULL AS array<struct<start:int,length:int>>) AS runs"
    )
    return flagged.union(nameless).mapInPandas(
        tidy(remove), "doc_id long, n_words long, n_removed long, kept string"
    )


def remove_repeats(docs: DataFrame, size: int = 20, group: int = GROUP) -> DataFrame:
    """The documents without their repeated words, and without those that have no word left.

    A text that loses words is the kept ones joined by a space, and n_chars follows it; other texts
    stay as they are, also those that had no word before.
    """

    @F.pandas_udf("string")
    def rest(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, copy, runs in columns:
            out = []
            for value, whole, found in zip(text, copy, runs):
                words = (value or "").encode("utf-8", "surrogatepass").split()
                stay, gone = kept_words(words, whole is True or whole is np.True_, found, size)
                out.append(b" ".join(stay).decode("utf-8", "surrogatepass") if gone else value)
            yield pd.Series(out, dtype=object)
        hand_back()

    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    flags = removals(texts, size, group).select(F.col("doc_id").alias("id"), "copy", "runs")
    whole = docs.select(F.struct(*docs.columns).alias("doc"))
    joined = whole.join(flags, F.col("doc.doc_id") == F.col("id"), "left")
    changed = joined.select("doc", rest("doc.text", "copy", "runs").alias("rest"))
    left = changed.where("rest IS NULL OR rest <> '' OR doc.text = ''")
    columns = []
    for field in docs.schema:
        value = F.col(f"doc.`{field.name}`")
        if field.name == "text":
            value = F.col("rest")
        elif field.name == "n_chars":
            new = F.length("rest").cast(field.dataType)
            value = F.when(F.col("rest") != F.col("doc.text"), new).otherwise(value)
        columns.append(value.alias(field.name))
    return left.select(*columns)


def digest(cleaned: DataFrame) -> DataFrame:
    """The rows of `without_repeats` with a SHA-256 of the kept words in place of them."""
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
