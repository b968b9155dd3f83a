"""Benchmark passages in training documents, by an FM-index per training shard.

1. The windows of an item are its runs of `size` consecutive terms; an item of fewer terms is one
   window. Distinct (window, item) pairs are dealt by hash to blocks of a bounded number, and only a
   block is ever broadcast. Terms of more than 64 bytes go by their hash, so a pair has a bounded size.
2. A shard is a stretch of `at_once` terms of the documents of one task. Its terms are numbered, every
   document ends with a number of its own, and an FM-index is built over them.
3. The windows of a block are searched backwards, all at once, through the ranks of the wavelet tree;
   those that occur are located by the sampled suffix places.
4. The places become spans of the documents' terms; spans that overlap or touch are merged.

With one block a shard is searched as soon as it is built, and nothing is shuffled. With more, the
indexes are written to the shared folder once and read per block; then the spans meet per document.

Cases: null and empty texts have no terms and are hit by nothing; every row is a document of its own,
so repeated rows and ids give repeated results, and null ids stay null; items with a null id or without
terms have no windows, and rows of one item id are one item; a text longer than a shard is cut into
shards that share `size - 1` terms, so no window is lost; equal windows of several items count for each;
empty tables give an empty or an unhit result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import keyed, rekeyed, shipped, stored, tidy
from farelake.llm.fm_index import FmIndex
from farelake.llm.terms import bounded, bounded_terms, term_list, terms

#: Terms of a shard.
AT_ONCE = 1 << 19
#: A block holds about so many (window, item) pairs, and hardly more; see `blocks`.
PAIRS = 100_000

SPANS = "array<struct<start: bigint, end: bigint>>"
HITS = f"number bigint, doc_id string, n_words bigint, spans {SPANS}, items array<string>"
SHARD = "fm binary, terms binary, pieces binary"


class Piece(NamedTuple):
    """Terms of a document from `offset` on; `number` tells the documents of a job apart."""

    number: int
    doc_id: str | None
    n_words: int
    offset: int
    terms: list[bytes]


class Block(NamedTuple):
    """Distinct terms; windows by length, as places in `terms`; the items of each window."""

    terms: list[bytes]
    windows: dict[int, np.ndarray]
    items: dict[int, list[list[str]]]


class Shard:
    """The FM-index of some pieces, and what its numbers mean. Piece i ends with the number i."""

    def __init__(self, fm: FmIndex, names: list[bytes], pieces: list[tuple], lengths: list[int]) -> None:
        self.fm, self.pieces, self.lengths = fm, pieces, lengths
        self.number = {name: len(pieces) + i for i, name in enumerate(names)}

    @classmethod
    def build(cls, pieces: list[Piece]) -> Shard:
        number = count(len(pieces))
        seen: defaultdict[bytes, int] = defaultdict(number.__next__)
        parts = []
        for i, piece in enumerate(pieces):
            parts.append(np.fromiter(map(seen.__getitem__, piece.terms), np.int64, len(piece.terms)))
            parts.append(np.array([i]))
        ids = np.concatenate(parts)
        fm = FmIndex.build(ids, len(pieces) + len(seen))
        return cls(fm, list(seen), [tuple(p[:4]) for p in pieces], [len(p.terms) for p in pieces])

    def hits(self, block: Block) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
        """(piece, spans, items) of the pieces that windows of the block occur in."""
        places = np.array([self.number.get(term, -1) for term in block.terms], dtype=np.int64)
        starts = np.cumsum([0, *[n + 1 for n in self.lengths]])
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        items: dict[int, set[str]] = defaultdict(set)
        for size, windows in block.windows.items():
            phrases = places[windows]
            there = np.flatnonzero((phrases >= 0).all(axis=1))
            if not len(there):
                continue
            which, low, high = self.fm.ranges(phrases[there])
            at, owner = self.fm.locate(low, high)
            pieces = np.searchsorted(starts, at, side="right") - 1
            owners = block.items[size]
            windows_hit = there[which[owner]]
            for piece, start in zip(pieces.tolist(), (at - starts[pieces]).tolist(), strict=True):
                spans[piece].append((start, start + size))
            for piece, window in set(zip(pieces.tolist(), windows_hit.tolist(), strict=True)):
                items[piece].update(owners[window])
        for piece in spans:
            yield piece, merged(spans[piece]), items[piece]

    def to_row(self) -> tuple[bytes, bytes, bytes]:
        told = pd.DataFrame(self.pieces, columns=["number", "doc_id", "n_words", "offset"])
        return self.fm.to_bytes(), b"\n".join(self.number), told.assign(length=self.lengths).to_json(orient="split").encode()

    @classmethod
    def from_row(cls, fm: bytes, names: bytes, pieces: bytes) -> Shard:
        rows = json.loads(pieces)["data"]
        found = names.split(b"\n") if names else []
        return cls(FmIndex.from_bytes(fm), found, [tuple(r[:4]) for r in rows], [r[4] for r in rows])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as disjoint spans in order; touching ones are one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(start, end) for start, end in out]


def shards(frames: Iterator[pd.DataFrame], size: int, at_once: int) -> Iterator[list[Piece]]:
    """The documents of a task in lists of about `at_once` terms; long ones in overlapping pieces."""
    context = TaskContext.get()
    number = count((context.partitionId() if context else 0) << 40)
    held: list[Piece] = []
    room = at_once
    for frame in frames:
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            found, mine = bounded(term_list(text)), next(number)
            for offset in range(0, max(1, len(found) - size + 1), at_once):
                part = found[offset : offset + at_once + size - 1]
                if held and len(part) > room:
                    yield held
                    held, room = [], at_once
                held.append(Piece(mine, doc_id, len(found), offset, part))
                room -= len(part)
    if held:
        yield held


def hit_rows(shard: Shard, block: Block) -> Iterator[list]:
    """A row per piece: number, doc_id, n_words, spans of the document, items."""
    found = {piece: (spans, items) for piece, spans, items in shard.hits(block)}
    for i, (number, doc_id, n_words, offset) in enumerate(shard.pieces):
        spans, items = found.get(i, ((), ()))
        yield [number, doc_id, n_words, [(s + offset, e + offset) for s, e in spans], set(items)]


def joined(rows: Iterator[list]) -> Iterator[list]:
    """Rows of one document next to each other become one."""
    held: list | None = None
    for row in rows:
        if held and held[0] == row[0]:
            held[3], held[4] = merged(held[3] + row[3]), held[4] | row[4]
        else:
            if held:
                yield held
            held = row
    if held:
        yield held


def framed(rows: Iterator[list], at_once: int = 5_000) -> Iterator[pd.DataFrame]:
    """Rows as frames of the schema of hits."""
    held = []
    for number, doc_id, n_words, spans, items in rows:
        held.append((number, doc_id, n_words, [{"start": s, "end": e} for s, e in spans], sorted(items)))
        if len(held) == at_once:
            yield pd.DataFrame(held, columns=["number", "doc_id", "n_words", "spans", "items"])
            held = []
    if held:
        yield pd.DataFrame(held, columns=["number", "doc_id", "n_words", "spans", "items"])


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct (item_id, window) pairs; item_id as text, a window as its terms joined by a space."""
    named = items.where("item_id IS NOT NULL")
    found = named.select(F.col("item_id").cast("string").alias("item"), bounded_terms(terms(F.col("text"))).alias("found"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("found") - size + 1, F.lit(1)))
    window = F.transform(starts, lambda i: F.array_join(F.slice("found", i, size), " "))
    return found.where(F.size("found") > 0).select("item", F.explode(window).alias("window")).distinct()


def blocks(windows: DataFrame, pairs: int) -> list[DataFrame]:
    """The (window, item) pairs in parts of about `pairs`, and never more than twice that and a hundred."""
    parts = max(1, math.ceil(windows.count() / pairs))
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("window", "item"), F.lit(parts)))
    largest = dealt.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    if largest > 2 * pairs + 100:
        raise ValueError(f"{largest} windows in a block for {pairs}")
    return [dealt.where(F.col("part") == part).select("window", "item") for part in range(parts)]


def collected(pairs: DataFrame) -> Block:
    """One block at the driver."""
    rows = [(r.window, r.item) for r in pairs.collect()]
    number: dict[bytes, int] = {}
    windows: dict[int, dict[tuple[int, ...], list[str]]] = defaultdict(lambda: defaultdict(list))
    for window, item in rows:
        key = tuple(number.setdefault(term, len(number)) for term in window.encode().split(b" "))
        windows[len(key)][key].append(item)
    return Block(
        list(number),
        {size: np.array(list(found), dtype=np.int64) for size, found in windows.items()},
        {size: list(found.values()) for size, found in windows.items()},
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = 10,
    at_once: int = AT_ONCE,
    pairs: int = PAIRS,
) -> DataFrame:
    """doc_id, n_words, `spans` of terms inside windows of the items, and the `items` they are of.

    One row per document. A span starts at a term, counted from 0, and ends before one.
    """
    spark = docs.sparkSession
    shipped(spark)
    parts = blocks(stored(item_windows(items, size), "windows"), pairs)
    if len(parts) > 1:
        return rekeyed(over_blocks(docs, parts, size, at_once).drop("number"), docs)
    sent = spark.sparkContext.broadcast(collected(parts[0]))

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for pieces in shards(frames, size, at_once) for row in hit_rows(Shard.build(pieces), sent.value))
        yield from framed(joined(rows))

    return rekeyed(keyed(docs).mapInPandas(tidy(search), HITS).drop("number"), docs)


def over_blocks(docs: DataFrame, parts: list[DataFrame], size: int, at_once: int) -> DataFrame:
    """Hits by indexes that are built once and searched for block after block."""
    context = docs.sparkSession.sparkContext

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pieces in shards(frames, size, at_once):
            yield pd.DataFrame([Shard.build(pieces).to_row()], columns=["fm", "terms", "pieces"])

    index = stored(keyed(docs).mapInPandas(tidy(build), SHARD), "fm_index")

    def hits(pairs: DataFrame) -> DataFrame:
        sent = context.broadcast(collected(pairs))

        def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    yield from framed(hit_rows(Shard.from_row(*row), sent.value))

        return stored(index.mapInPandas(tidy(search), HITS), "hits")

    together = (
        reduce(DataFrame.unionAll, [hits(part) for part in parts])
        .groupBy("number", "doc_id", "n_words")
        .agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    )

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            spans = [merged([(s["start"], s["end"]) for s in row]) for row in frame["spans"]]
            told = zip(frame["number"], frame["doc_id"], frame["n_words"], spans, frame["items"], strict=True)
            yield from framed(told)

    return together.mapInPandas(tidy(merge), HITS)


def digest(found: DataFrame) -> DataFrame:
    """One line per document: terms, terms hit, items, a hash of the item ids in order of their text."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
