"""Ranks and scores against a walk over all documents and terms."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from farelake.llm import ranked_search
from farelake.llm.terms import term_list
from samples import awkward, empty


def brute(docs, items, top):
    lists = [(i, term_list(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in lists), sum(len(w) for _, w in lists)
    df = Counter(t for _, w in lists for t in set(w))
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(term_list(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, words in lists:
            counts, score = Counter(words), 0
            for term in wanted & set(counts):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 50 + (50 * len(words) * n_docs) // n_terms
                score += weight * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort()
        out += [(item, rank, doc_id, -low) for rank, (low, _, doc_id) in enumerate(scored[:top], 1)]
    return sorted(out)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def random_tables(seed, skew):
    """Terms from rare to very frequent, so that every owner has some; copies, ties and empty texts."""
    rng = random.Random(seed)
    letters = [f"t{i}" for i in range(400)]
    weights = [1 / (i + 1) ** skew for i in range(400)]
    text = lambda n: " ".join(rng.choices(letters, weights, k=rng.randrange(n)))
    docs = [(i * 7 % 1009, text(60)) for i in range(600)]
    docs += [(5000 + i, docs[3][1]) for i in range(40)] + [(9000, None), (9001, "")] + docs[:3]
    items = [(i, text(40)) for i in range(25)] + [(3, "t1 T2, t399"), (None, "t1"), (40, None), (41, "none of them")]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    docs, items = random_tables(seed, (0.7, 1.0, 1.4)[seed])
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked_search.search(frame, asked, top=(5, 10, 3)[seed], docs_at_once=(64, 8192, 7)[seed], items_at_once=9)
    assert rows(found) == brute(docs, items, (5, 10, 3)[seed])


def test_pruning_leaves_documents_out(spark):
    # The bar of the rare terms closes the items, so the frequent terms bring no new documents.
    docs = [(i, f"common other{i}") for i in range(2000)] + [(3000 + i, "rare common words") for i in range(4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([("a", "rare words common")], "item_id string, text string")
    found = rows(ranked_search.search(frame, asked, top=4))
    assert [r[2] for r in found] == [3000, 3001, 3002, 3003]
    assert found == brute(docs, [("a", "rare words common")], 4)


def test_awkward_rows_and_empty(spark):
    docs = awkward(spark, "term slice item score rank at bundle")
    items = [("a", "the same ROW, twice; two WORDS"), ("b", "w0 w1 w976"), ("c", ""), ("d", "éñß 日本")]
    asked = spark.createDataFrame(items, "item_id string, text string")
    known = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: (r[0], r[1])
    found = [tuple(r) for r in ranked_search.search(docs, asked).collect()]
    assert sorted(found, key=key) == sorted(brute(known, items, 50), key=key)
    assert ranked_search.search(empty(spark), asked).count() == 0
    assert ranked_search.search(docs, asked.limit(0)).count() == 0


def test_ids_as_text(spark):
    docs = [("b", "x y"), ("a", "x y"), ("c", "x"), ("é", "x y"), ("e", "z")]
    frame = spark.createDataFrame(docs, "doc_id string, text string")
    asked = spark.createDataFrame([(1, "y")], "item_id int, text string")
    assert [r.doc_id for r in ranked_search.search(frame, asked).orderBy("rank").collect()] == ["a", "b", "é"]
