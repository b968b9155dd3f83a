"""Ranked lexical search by pipelined term partitioning, in integers, exact to the last place.

1. `postings`: documents are indexed in slices of a bounded size. In a slice they are numbered by doc_id;
   per term there is one row with the documents' numbers, occurrences and lengths. Terms that no item
   has are left out by a table of bits of a fixed size, set by hash; the few strangers that pass find
   no partner later.
2. A term's weight, and the most that it adds to any score, follow from its postings. Every term has one
   owner: the rarest terms belong to the first, the most frequent ones to the last.
3. Items are dealt to bundles. A bundle visits the owners one after the other. It carries, per slice and
   item, the documents found so far with their partial scores (sparse accumulators); at an owner it is
   cogrouped with that owner's postings of the slice, and adds weight times contribution.
4. Between two owners the `top`-th best partial score of every item is found. What the owners to come
   can add at most decides who goes on: documents that cannot reach that score any more leave, and no
   new ones enter once all terms to come cannot reach it together. Both rules drop nothing that could
   rank, ties included.
5. After the last owner the best of every slice meet, by score, then doc_id.

A group of the cogroup is one bundle in one slice, so its size is bounded however frequent a term is and
however many documents match. Accumulators are written to the shared folder between owners.

Cases: null and empty texts have no terms and never rank, nor count as documents; every row is a document
of its own, so repeated rows rank side by side; equal scores rank by doc_id (whole numbers by value, other
ids by text, null last); items with a null id or without terms have no rows, and rows of one item id are
one item; texts are used whole; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.llm.common import keyed, shipped, stored, tidy
from farelake.llm.terms import bounded, bounded_terms, term_list, terms

#: Documents and postings of a slice; items of a bundle.
DOCS, POSTINGS, ITEMS = 8192, 1 << 20, 256
#: A term belongs to the first owner for whom its share of the documents is small enough; else to the last.
SHARES = (1 / 512, 1 / 64, 1 / 8)
#: Bits of the table of the items' terms, whatever their number: 1 MB.
TERM_BITS = 1 << 23

INDEX = "slice bigint, term string, at array<int>, tf array<int>, n array<int>, ids array<string>"
CARRIED = "bundle bigint, slice bigint, item string, at array<int>, score array<bigint>, best array<bigint>"


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item, term); the item id as text."""
    found = F.explode(bounded_terms(terms(F.col("text")))).alias("term")
    named = items.where("item_id IS NOT NULL")
    return named.select(F.col("item_id").cast("string").alias("item"), found).distinct()


def term_bits(wanted: DataFrame) -> np.ndarray:
    """The table of bits of the terms; at most one row per 32 bits reaches the driver."""
    slot = F.crc32("term") % TERM_BITS
    told = wanted.select(slot.alias("slot")).groupBy(F.expr("slot div 32").alias("word"))
    words = told.agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 32 AS int)))").alias("bits")).toPandas()
    bits = np.zeros(TERM_BITS >> 5, dtype=np.uint32)
    bits[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return bits


class Wanted(dict):
    """Whether a term may be one of the items'; remembers its answers."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __missing__(self, term: bytes) -> bool:
        slot = zlib.crc32(term) % TERM_BITS
        answer = self[term] = bool((int(self.bits[slot >> 5]) >> (slot & 31)) & 1)
        return answer


def slice_rows(number: int, ids: list[str | None], lengths: list[int], found: dict, whole: bool) -> pd.DataFrame:
    """The rows of one slice: its documents in order, and its postings per term."""

    def place(row: int) -> tuple:
        doc_id = ids[row]
        return (doc_id is None, 0 if doc_id is None else int(doc_id) if whole else doc_id)

    order = np.array(sorted(range(len(ids)), key=place), dtype=np.int64)
    new = np.empty(len(ids), dtype=np.int32)
    new[order] = np.arange(len(ids), dtype=np.int32)
    n = np.array(lengths, dtype=np.int32)[order]
    rows = [(number, None, np.zeros(0, np.int32), np.zeros(0, np.int32), n, [ids[i] for i in order])]
    for term, (docs, counts) in found.items():
        at = new[docs]
        by = np.argsort(at)
        at = at[by]
        rows.append((number, term.decode("utf-8"), at, np.array(counts, dtype=np.int32)[by], n[at], None))
    return pd.DataFrame(rows, columns=["slice", "term", "at", "tf", "n", "ids"])


def postings(docs: DataFrame, wanted: DataFrame, docs_at_once: int = DOCS, postings_at_once: int = POSTINGS) -> DataFrame:
    """Per slice and term the documents' numbers, occurrences and lengths; a row without term lists the documents."""
    sent = docs.sparkSession.sparkContext.broadcast(term_bits(wanted))
    whole = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        ids: list[str | None] = []
        lengths: list[int] = []
        found: dict[bytes, tuple[list[int], list[int]]] = {}
        asked, held = Wanted(sent.value), 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                if len(ids) >= docs_at_once or held >= postings_at_once:
                    yield slice_rows(number, ids, lengths, found, whole)
                    number, ids, lengths, found, held = number + 1, [], [], {}, 0
                    asked = Wanted(sent.value)
                words = bounded(term_list(text))
                row = len(ids)
                ids.append(doc_id)
                lengths.append(len(words))
                for term, times in Counter(words).items():
                    if asked[term]:
                        docs_of, counts = found.setdefault(term, ([], []))
                        docs_of.append(row)
                        counts.append(times)
                        held += 1
        if ids:
            yield slice_rows(number, ids, lengths, found, whole)

    return keyed(docs).mapInPandas(tidy(index), INDEX)


def contributions(n_docs: int, n_terms: int) -> Column:
    """Per posting what it adds for a weight of one: rising with occurrences, falling with the document's length."""
    m = f"(50 + (50L * n * {n_docs}L) div {max(n_terms, 1)}L)"
    return F.expr(f"zip_with(tf, n, (tf, n) -> (1000000000L * tf) div (1000L * tf + 20L * {m}))")


def weighted(index: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Per term: weight, the most it adds to a score, and its owner."""
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    owner = sum(F.when(F.col("df") > share * n_docs, 1).otherwise(0) for share in SHARES)
    return (
        index.where("term IS NOT NULL")
        .select("term", F.size("at").alias("held"), F.array_max(contributions(n_docs, n_terms)).alias("most"))
        .groupBy("term")
        .agg(F.sum("held").alias("df"), F.max("most").alias("most"))
        .select("term", weight.alias("weight"), (weight * F.col("most")).alias("most"), owner.alias("owner"))
    )


def add_up(key: tuple, carried: pd.DataFrame, held: pd.DataFrame, top: int) -> pd.DataFrame:
    """A bundle at an owner, in one slice: old accumulators and the owner's postings make new ones."""
    before = {row.item: row for row in carried.itertuples(index=False)}
    adds: dict[str, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    rules = {item: (row.enters, row.least) for item, row in before.items()}
    size = 1 + max((int(at[-1]) for frame in (carried, held) for at in frame["at"] if len(at)), default=0)
    for row in held.itertuples(index=False):
        at, adding = row.at, row.adds
        for told in row.items:
            rules[told["item"]] = (told["enters"], told["least"])
            adds.setdefault(told["item"], []).append((row.weight, at, adding))
    out = []
    for item, (enters, least) in rules.items():
        scores = np.zeros(size, dtype=np.int64)
        there = before.get(item)
        if there is not None:
            scores[there.at] = there.score
        known = scores > 0
        for weight, at, adding in adds.get(item, ()):
            scores[at] += weight * adding
        stays = scores >= max(least, 1)
        if not enters:
            stays &= known
        at = np.flatnonzero(stays)
        if len(at):
            score = scores[at]
            best = np.sort(np.partition(score, -top)[-top:] if len(score) > top else score)
            out.append((*key, item, at.astype(np.int32), score, best))
    return pd.DataFrame(out, columns=["bundle", "slice", "item", "at", "score", "best"])


def bars(carried: DataFrame, top: int) -> DataFrame:
    """Per item with `top` documents or more the `top`-th best partial score."""
    each = carried.select("item", F.explode("best").alias("score"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    return each.withColumn("place", place).where(F.col("place") <= top).groupBy("item").agg(
        F.min("score").alias("bar"), F.count(F.lit(1)).alias("n")
    ).where(F.col("n") == top).drop("n")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 50,
    docs_at_once: int = DOCS,
    items_at_once: int = ITEMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the `top` best documents of every item, scores above 0 only."""
    spark: SparkSession = docs.sparkSession
    shipped(spark)
    asked = stored(item_terms(items), "item_terms")
    index = stored(postings(docs, asked, docs_at_once), "postings")
    lengths = index.where("term IS NULL").select("n")
    n_docs, n_terms = lengths.agg(
        F.sum(F.size(F.filter("n", lambda n: n > 0))), F.sum(F.aggregate("n", F.lit(0).cast("bigint"), lambda s, n: s + n))
    ).first()
    n_docs, n_terms = int(n_docs or 0), int(n_terms or 0)
    owners = range(len(SHARES) + 1)

    # Weights of the items' terms, and per item what the owners from one on can add at most.
    weights = stored(weighted(index, n_docs, n_terms).join(asked.select("term").distinct(), "term", "left_semi"), "weights")
    bundles = max(1, math.ceil(asked.select("item").distinct().count() / items_at_once))
    known = stored(
        asked.join(weights, "term").withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles))), "weighted_items"
    )
    limits = stored(
        known.groupBy("item").agg(
            *[F.sum(F.when(F.col("owner") >= s, F.col("most")).otherwise(0)).alias(f"rest_{s}") for s in owners]
        ),
        "limits",
    )

    carried = spark.createDataFrame([], CARRIED)
    bar = spark.createDataFrame([], "item string, bar bigint")
    for owner in owners:
        here, after = F.col(f"rest_{owner}"), F.col(f"rest_{owner + 1}") if owner + 1 in owners else F.lit(0)
        reach = F.coalesce("bar", F.lit(0))
        # New documents enter while all terms to come may lift them to the bar; below `least` nobody gets there.
        rules = stored(
            limits.join(bar, "item", "left").select("item", (here >= reach).alias("enters"), (reach - after).alias("least")),
            "rules",
        )
        sought = stored(
            known.where(F.col("owner") == owner)
            .join(rules, "item")
            .groupBy("bundle", "term", "weight")
            .agg(F.collect_list(F.struct("item", "enters", "least")).alias("items")),
            "sought",
        )
        held = (
            index.join(sought, "term")
            .select("bundle", "slice", "weight", "items", "at", contributions(n_docs, n_terms).alias("adds"))
            .groupBy("bundle", "slice")
        )
        old = carried.drop("best").join(rules, "item").groupBy("bundle", "slice")

        def visit(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return add_up(key, left, right, top)

        carried = stored(old.cogroup(held).applyInPandas(visit, CARRIED), "accumulators")
        bar = bars(carried, top)
    return ranked(carried, bar, index, docs, items, top)


def ranked(carried: DataFrame, bar: DataFrame, index: DataFrame, docs: DataFrame, items: DataFrame, top: int) -> DataFrame:
    """The best documents of every item, over all slices."""
    # Numbers in a slice rise with doc_id, so the best of a slice are its highest scores, then lowest numbers.
    pairs = F.arrays_zip(F.transform("score", lambda s: -s).alias("low"), F.col("at"))
    best = carried.select("bundle", "slice", "item", F.slice(F.array_sort(pairs), 1, top).alias("found"))
    over = (
        best.join(bar, "item", "left")
        .select("bundle", "slice", "item", F.explode("found").alias("f"), "bar")
        .where("-f.low >= coalesce(bar, 1)")
        .groupBy("bundle", "slice")
        .agg(
            F.collect_list(F.struct("item", F.col("f.at").alias("at"), (-F.col("f.low")).alias("score"))).alias("found")
        )
    )
    documents = index.where("term IS NULL").select("slice", "ids")
    named = over.join(documents, "slice").select(
        F.explode(
            F.transform("found", lambda f: F.struct(f["item"], F.get("ids", f["at"]).alias("id"), f["score"]))
        ).alias("f")
    )
    rows = named.select(
        F.col("f.item").cast(items.schema["item_id"].dataType).alias("item_id"),
        F.col("f.id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("f.score").alias("score"),
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranks = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranks.select("item_id", "rank", "doc_id", "score")
