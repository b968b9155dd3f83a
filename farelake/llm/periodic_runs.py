"""Runs of repeated words by maximal pairs over the LCP-interval tree of each text.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbouring
word extends. With an exponent of `exponent` or more, it is at least that many periods long.

1. Texts are dealt to batches of `at_once` words. The words of a batch are numbered so that words of
   different texts differ; all its suffixes are sorted together, by three words first and then by
   doubled prefixes, where only suffixes that still have an equal are sorted again.
2. The common prefixes of neighbours give the LCP-interval tree. It is walked bottom-up; an interval of
   fewer words than any run needs is never built, so texts without repeats cost one sort.
3. An interval holds its leaves in text order, and in one list per left word (the word before the
   suffix). When two children meet at depth h, a leaf of the smaller one looks for leaves of another
   left word in the larger one. Such a pair, at distance d, is a maximal pair: the words before differ,
   and so do the words after h equal ones. Where h >= (exponent - 1) * d, it is a run from the first
   leaf, d + h words long, and nothing has to be extended.
4. Leaves within that distance of each other stand at multiples of one period, and all but the first
   of them have the same left word. So a leaf has at most one partner to its left, found by halving
   the stretch of its own left word, and partners to its right only if it is the first one.
5. A run of several periods gives a pair per multiple of its smallest period; the smallest counts.

Merging the smaller child into the larger one keeps the work at n log n searches for n words of a text.

Cases: null text has no words; empty texts, and texts without runs, have no runs and keep all words;
every row is a text of its own, so repeated rows and ids give repeated results, and null ids stay null;
texts are used whole, and one longer than a batch is a batch of its own; ties do not arise, as runs of
one start have different periods; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import keyed, let, rekeyed, shipped, tidy, words
from farelake.llm.suffixes import suffix_order

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
FOUND = f"doc_id string, n_words bigint, runs {RUNS}, collapsed string"

#: Words per batch, unless one text has more.
AT_ONCE = 1 << 18


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """One number per word; the same one only for equal words of one text. A last number ends them all."""
    parts, used = [], 0
    for found in texts:
        number = count(used)
        seen: defaultdict[bytes, int] = defaultdict(number.__next__)
        parts.append(np.fromiter(map(seen.__getitem__, found), dtype=np.int64, count=len(found)))
        used += len(seen)
    parts.append(np.array([used], dtype=np.int64))
    return np.concatenate(parts)


def common_prefixes(ids: list[int], order: list[int], follows: list[bool]) -> list[int]:
    """Words that each sorted suffix shares with the one before it; 0 where that is fewer than three."""
    before = {at: order[i - 1] for i, at in enumerate(order) if follows[i]}
    length, last, h = {}, -2, 3
    for at in sorted(before):
        other = before[at]
        h = max(h - 1, 3) if at == last + 1 else 3
        while ids[at + h] == ids[other + h]:
            h += 1
        length[at], last = h, at
    return [length.get(at, 0) for at in order]


class Leaves:
    """Suffixes below an interval: in text order, and in one list per left word."""

    __slots__ = ("order", "lists")

    def __init__(self, at: int, left: int) -> None:
        self.order, self.lists = [at], {left: [at]}

    def partners(self, at: int, left: int, reach: int) -> Iterator[tuple[int, int]]:
        """(first, second) of the pairs of suffix `at` with leaves of other left words, `reach` apart at most."""
        order = self.order
        here = bisect_left(order, at)
        if here and at - order[here - 1] <= reach:
            same = self.lists.get(left, ())
            last = bisect_left(same, at)
            low, high = 0, min(here, last)
            # The stretch of the same left word that ends here: places in both lists go down together.
            while low < high:
                half = (low + high + 1) // 2
                if order[here - half] == same[last - half]:
                    low = half
                else:
                    high = half - 1
            if here > low and at - order[here - low - 1] <= reach:
                yield order[here - low - 1], at
        if here < len(order) and order[here] - at <= reach:
            nearest = order[here]
            same = self.lists.get(left, ())
            place = bisect_left(same, nearest)
            if place == len(same) or same[place] != nearest:
                for other in order[here : bisect_right(order, at + reach)]:
                    yield at, other

    def take(self, others: Leaves) -> None:
        for at in others.order:
            insort(self.order, at)
        for left, found in others.lists.items():
            mine = self.lists.setdefault(left, [])
            for at in found:
                insort(mine, at)


def maximal_pairs(
    order: list[int], shared: list[int], left: list[int], floor: int, times: int
) -> Iterator[tuple[int, int, int]]:
    """(first, distance, depth) of the maximal pairs with `times` * distance <= depth, and depth >= floor."""
    stack: list[tuple[int, Leaves]] = []

    def meet(inner: Leaves, outer: Leaves, depth: int) -> tuple[Leaves, list[tuple[int, int, int]]]:
        small, large = (inner, outer) if len(inner.order) <= len(outer.order) else (outer, inner)
        reach = depth // times
        found = [
            (first, second - first, depth)
            for word, ats in small.lists.items()
            for at in ats
            for first, second in large.partners(at, word, reach)
        ]
        large.take(small)
        return large, found

    for i, at in enumerate(order):
        following = shared[i + 1] if i + 1 < len(order) else 0
        if following < floor and not stack:
            continue
        child = Leaves(at, left[at])
        while stack and stack[-1][0] > following:
            depth, open_one = stack.pop()
            child, found = meet(child, open_one, depth)
            yield from found
        if following >= floor:
            if stack and stack[-1][0] == following:
                depth, open_one = stack.pop()
                child, found = meet(child, open_one, depth)
                yield from found
            stack.append((following, child))


def runs_of(texts: list[list[bytes]], least: int = 6, exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, by start, then period."""
    starts = np.cumsum([0, *map(len, texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    times = exponent - 1
    floor = next(h for h in range(3, least + exponent) if h >= times and h + h // times >= least)
    if starts[-1] == 0:
        return out
    ids = numbered(texts)
    order, differs = suffix_order(ids)
    # Suffixes that share no three words with another one are left out.
    kept = ~(differs & np.concatenate([differs[1:], [True]]))
    order, plain = order[kept], ids.tolist()
    if not len(order):
        return out
    shared = common_prefixes(plain, order.tolist(), (~differs[kept]).tolist())
    # The first word of a text has a left word that no other has.
    left = [-1, *plain]
    for start in starts[:-1].tolist():
        left[start] = -1
    best: dict[tuple[int, int], int] = {}
    for first, distance, depth in maximal_pairs(order.tolist(), shared, left, floor, times):
        key = (first, distance + depth)
        if key[1] >= least and distance < best.get(key, distance + 1):
            best[key] = distance
    found = sorted((first, period, length) for (first, length), period in best.items())
    owners = np.searchsorted(starts, [first for first, _, _ in found], side="right") - 1
    for owner, (first, period, length) in zip(owners.tolist(), found, strict=True):
        out[owner].append((first - int(starts[owner]), length, period))
    return out


def collapsed(text: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(text)
    gone = np.zeros(len(text) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return b" ".join([text[i] for i in kept.tolist()])


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4, at_once: int = AT_ONCE) -> DataFrame:
    """doc_id, n_words, runs of at least `least` words and `exponent` periods, and the text without repeats.

    One row per row. Nothing is shuffled. `exponent` is 4 or more, so that pairs share three words at least.
    """
    if exponent < 4:
        raise ValueError(f"runs are found from 4 periods on, not {exponent}")
    shipped(docs.sparkSession)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[str | None] = []
        texts: list[list[bytes]] = []
        held = 0

        def found() -> pd.DataFrame:
            runs = runs_of(texts, least, exponent)
            rows = [
                (i, len(t), [{"start": s, "length": n, "period": q} for s, n, q in r], collapsed(t, r).decode("utf-8"))
                for i, t, r in zip(ids, texts, runs, strict=True)
            ]
            return pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "collapsed"])

        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                split = (text or "").encode("utf-8").split()
                if texts and held + len(split) > at_once:
                    yield found()
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(split)
                held += len(split)
        if texts:
            yield found()

    return rekeyed(keyed(docs).mapInPandas(tidy(scan), FOUND), docs)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, picked by the hash of the id, turn periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    picked = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text"))))
    n, g = F.size("w").cast("bigint"), F.expr("h div 10")
    placed = picked.withColumns({"n": n, "g": g, "a": F.when(n > 0, F.pmod(g, n))})
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def periodic(s: Column) -> Column:
        def word(i: Column) -> Column:
            return F.get(s["w"], F.when(i < s["a"], i).otherwise(s["a"] + F.pmod(i - s["a"], s["p"])).cast("int"))

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(s["w"]) - 1), word), " ")

    text = let(F.struct("w", "a", "p"), periodic)
    return placed.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One line per text: the number of runs, the longest one, and hashes of all runs and of the words kept."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    ranked = F.array_sort(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("q")))
    )
    top = F.get(ranked, 0)
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("top.s").alias("start"),
        (-F.col("top.l")).alias("length"),
        F.col("top.q").alias("period"),
        F.expr("(1000 * -top.l) div top.q").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
