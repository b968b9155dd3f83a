"""Pack token pieces into sequences: patterns of few documents by non-negative least squares.

1. `tokenize` turns each document into token ids and an end token, and cuts only what is longer than
   a sequence.
2. `plan` sees nothing but the histogram of piece lengths (as many numbers as a sequence has tokens).
   It enumerates the patterns of one to three lengths that fill a sequence, fits how often to repeat
   each one to the histogram by non-negative least squares, rounds, and packs what is left best-fit,
   longest lengths first, still as patterns with counts. Its size depends on the lengths that occur,
   not on the number of documents.
3. `pack` numbers the pieces of each length and looks up the slot of that number in the plan. A task
   numbers its own pieces as it cuts them; what is added is the count of that length in earlier tasks.
   So pieces, and their ids, are shuffled only where those counts are too many to be broadcast.

Cases: null and empty texts are the end token alone; rows that occur twice are packed twice; null
doc_ids are passed on; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.byte_bpe import open_tokenizer
from farelake.llm.common import keyed, rekeyed, stored, tidy


def cut(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the limit."""
    if total <= limit:
        return [(0, total)]
    first = total % limit or limit
    return [(0, first), *[(s, limit) for s in range(first, total, limit)]]


def tokenize(docs: DataFrame, tokenizer: str, limit: int = 2048, end: int = 0, keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, if asked for the `ids`, and `task` and `nth` of every piece.

    `nth` numbers the pieces of one length within a task.
    """
    tail = np.array([end], dtype="<u4").tobytes()

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = open_tokenizer(tokenizer)
        context = TaskContext.get()
        task, met = context.partitionId() if context else 0, Counter()
        for frame in frames:
            rows, ids = [], []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                packed = (bpe.encode(text) if text else b"") + tail
                for number, (start, length) in enumerate(cut(len(packed) // 4, limit)):
                    piece = packed[4 * start : 4 * (start + length)]
                    rows.append((doc_id, number, start, length, zlib.crc32(piece), task, met[length]))
                    met[length] += 1
                    if keep_ids:
                        ids.append(np.frombuffer(piece, dtype="<u4").astype(np.int32))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
            yield out.assign(ids=ids) if keep_ids else out

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long, task int, nth long"
    pieces = keyed(docs).mapInPandas(tidy(encode), schema + (", ids array<int>" if keep_ids else ""))
    return rekeyed(pieces, docs)


@dataclass(frozen=True)
class Plan:
    """Slots by length and number of the piece within its length: sequence and offset."""

    limit: int
    keys: np.ndarray  # length * SPAN + first number of the slot, ascending
    first_sequence: np.ndarray
    offset: np.ndarray
    sequences: int


SPAN = 1 << 50


def enumerate_patterns(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to the limit exactly, each with a <= b <= c."""
    present = np.zeros(limit + 1, dtype=bool)
    present[lengths] = True
    present[0] = True
    a, b = np.meshgrid(np.flatnonzero(present), np.flatnonzero(present), indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = limit - a - b
    fits = (c >= b) & (c > 0)
    a, b, c = a[fits], b[fits], c[fits]
    there = present[c]
    return np.stack([a[there], b[there], c[there]], axis=1)


def fit(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Non-negative repeat counts x that bring A x near the histogram, A being the patterns' lengths.

    Multiplicative updates keep x non-negative and never raise the squared error.
    """
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(patterns[:, k], x, size) for k in range(3))
        total[0] = 0
        return total

    def back(values: np.ndarray) -> np.ndarray:
        return values[patterns].sum(axis=1)

    target = histogram.astype(float)
    target[0] = 0
    wanted = back(target)
    x = wanted / np.maximum(back(used(np.ones(len(patterns)))), 1e-12)
    for _ in range(rounds):
        x *= wanted / np.maximum(back(used(x)), 1e-12)
    return x


def round_down(patterns: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Rounded counts that the histogram allows, largest first; takes them from `left`."""
    chosen = []
    counts = np.rint(x).astype(np.int64)
    for i in np.argsort(-x, kind="stable"):
        if counts[i] < 1:
            break
        pattern = tuple(int(v) for v in patterns[i] if v)
        most = min(left[v] // m for v, m in Counter(pattern).items())
        if (n := int(min(counts[i], most))) > 0:
            for v in pattern:
                left[v] -= n
            chosen.append((pattern, n))
    return chosen


def best_fit(left: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack what is left, longest first, each into the fullest open sequence that takes it.

    Equal sequences are one entry with a count, so the work depends on the lengths, not the pieces.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    spaces = np.zeros(limit + 1, dtype=bool)
    done = []
    for length in range(limit, 0, -1):
        count = int(left[length])
        while count:
            places = np.flatnonzero(spaces[length:])
            if len(places):
                space = length + int(places[0])
                pattern, n = open_[space].pop()
                spaces[space] = bool(open_[space])
                took = min(n, count)
                if took < n:
                    open_[space].append((pattern, n - took))
                    spaces[space] = True
            else:
                # Whole sequences of this length alone, or one sequence for the few that are left.
                many = limit // length
                took, each = (count // many, many) if count >= many else (1, count)
                pattern, space = (length,) * (each - 1), limit - length * (each - 1)
                count -= took * (each - 1)
            count -= took
            rest = space - length
            entry = ((*pattern, length), took)
            if rest:
                open_[rest].append(entry)
                spaces[rest] = True
            else:
                done.append(entry)
    return done + [entry for entries in open_.values() for entry in entries]


def plan(histogram: np.ndarray, limit: int) -> Plan:
    """The plan for a histogram of piece lengths (index 0 is unused)."""
    left = histogram.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []
    patterns = enumerate_patterns(np.flatnonzero(left), limit)
    if len(patterns):
        chosen = round_down(patterns, fit(patterns, left), left)
    chosen += best_fit(left, limit)
    taken: dict[int, int] = defaultdict(int)
    slots = []
    sequence = 0
    for pattern, count in chosen:
        offset = 0
        for length, same in groupby(sorted(pattern, reverse=True)):
            for _ in same:
                slots.append((length * SPAN + taken[length], sequence, offset))
                taken[length] += count
                offset += length
        sequence += count
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 3)
    return Plan(limit, table[:, 0], table[:, 1], table[:, 2], sequence)


def numbered(pieces: DataFrame) -> tuple[DataFrame, pd.DataFrame]:
    """The pieces with `number` (from 0 within their length), and the histogram of lengths.

    Only the counts per task and length move; a piece gets what the earlier tasks have of its length.
    """
    counts = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = stored(
        counts.selectExpr("length", "task", "sum(n) OVER (PARTITION BY length ORDER BY task) - n AS before"), "before"
    )
    joined = pieces.join(before, ["length", "task"]).withColumn("number", F.col("before") + F.col("nth"))
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).toPandas()
    return joined.drop("task", "before", "nth"), histogram


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """The pieces with `sequence_id` and `offset`. They have to be stored: their tasks are those of one run."""
    ranked, counted = numbered(pieces)
    histogram = np.zeros(limit + 1, dtype=np.int64)
    histogram[counted["length"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy(dtype=np.int64)
    layout = pieces.sparkSession.sparkContext.broadcast(plan(histogram, limit))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        slots = layout.value
        wanted = length.to_numpy(np.int64) * SPAN + number.to_numpy(np.int64)
        slot = np.searchsorted(slots.keys, wanted, side="right") - 1
        sequence = slots.first_sequence[slot] + wanted - slots.keys[slot]
        return pd.DataFrame({"sequence_id": sequence, "offset": slots.offset[slot]})

    placed = ranked.withColumn("slot", place("length", "number"))
    told = [c for c in pieces.columns if c not in ("task", "nth")]
    return placed.select(*told, "slot.sequence_id", "slot.offset")


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = 2048, keep_ids: bool = True) -> DataFrame:
    """Tokenize, store and pack; one row per piece."""
    return pack(stored(tokenize(docs, tokenizer, limit, keep_ids=keep_ids), "pieces"), limit)
