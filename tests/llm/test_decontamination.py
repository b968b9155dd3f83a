"""Hit spans against a walk over all windows; the index against plain search."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from farelake.llm import decontamination
from farelake.llm.fm_index import FmIndex
from farelake.llm.terms import TERM_BREAK, term_list, terms
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import awkward, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found_terms(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, size):
    """(n_words, n_hit, n_items, hash of the ids) per row, in the order of the rows."""
    windows = {}
    for item, text in items:
        words = found_terms(text)
        for i in range(max(1, len(words) - size + 1)):
            if words and item is not None:
                windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, ids = found_terms(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                owners = windows.get(tuple(words[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    ids |= owners
        names = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(ids), names, bool(hit)))
    return out


def rows(frame):
    return sorted((tuple(r) for r in decontamination.digest(frame).collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.lists(st.integers(1, 5), min_size=1, max_size=6))
def test_index_finds_all_places(numbers, phrase):
    fm = FmIndex.from_bytes(FmIndex.build(np.array([*numbers, 0]), 6).to_bytes())
    which, low, high = fm.ranges(np.array([phrase]))
    places, _ = fm.locate(low, high)
    k = len(phrase)
    assert sorted(places.tolist()) == [i for i in range(len(numbers) - k + 1) if numbers[i : i + k] == phrase]
    assert len(which) == (len(places) > 0)


def test_index_of_a_long_sequence():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(1, 900, 30_000), np.full(500, 7), rng.integers(1, 900, 10_000), [0]])
    fm = FmIndex.build(ids, 900)
    phrases = np.array([ids[i : i + 4] for i in range(0, 40_000, 37)] + [[7] * 4])
    which, low, high = fm.ranges(phrases)
    assert which.tolist() == list(range(len(phrases)))
    places, owner = fm.locate(low, high)
    windows = np.lib.stride_tricks.sliding_window_view(ids, 4)
    for i in (0, 5, len(phrases) - 1):
        assert sorted(places[owner == i].tolist()) == np.flatnonzero((windows == phrases[i]).all(axis=1)).tolist()


def test_terms_in_tasks_and_expressions(spark):
    texts = ["It's ÄÖ 9x_y[Z]`q`~ \x7f é 日本,ABC\x00d e", None, "", " .;", "A", "\U0001f600-z y"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in frame.select(terms(frame.text)).collect()]
    assert got == [found_terms(t) for t in texts]
    assert [[w.decode() for w in term_list(t)] for t in texts] == got
    assert TERM_BREAK.startswith("[")


def random_tables(seed):
    rng = random.Random(seed)
    letters = [f"w{i}" for i in range(12)] + ["Ä", "x" * 80, "y" * 80]
    text = lambda n: " ".join(rng.choices(letters, k=rng.randrange(n)))
    items = [(i, text(14)) for i in range(8)] + [(3, text(14)), (None, "w1"), (20, "w1"), (21, None), (22, "!")]
    docs = []
    for i in range(50):
        parts = [rng.choice(items)[1] or "" if rng.random() < 0.5 else text(40) for _ in range(rng.randrange(5))]
        docs.append((i % 45, rng.choice([" ", ", ", "\n"]).join(parts)))
    return docs + [(900, None), (None, items[0][1]), (901, "")], items


@pytest.mark.parametrize("shape", [{}, {"at_once": 7}, {"pairs": 3}, {"at_once": 5, "pairs": 9}])
def test_random_tables(spark, shape):
    docs, items = random_tables(len(shape) + 1)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(frame, tests, size=4, **shape)
    assert rows(found) == sorted(brute(docs, items, 4), key=str)
    for row in found.where("size(spans) > 0").collect():
        ends = [x for s in row.spans for x in (s.start, s.end)]
        assert ends == sorted(set(ends)) and ends[-1] <= row.n_words


def test_awkward_rows_and_empty(spark):
    docs = awkward(spark, "spans items number item_id window")
    items = spark.createDataFrame(
        [("a", "The same row, TWICE over"), ("b", "w0 w1"), ("c", None), (None, "one")], "item_id string, text string"
    )
    known = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute(known, [tuple(r) for r in items.collect()], 10)
    assert rows(decontamination.contamination(docs, items)) == sorted(want, key=str)
    assert decontamination.contamination(empty(spark), items).count() == 0
    nothing = decontamination.contamination(docs, items.limit(0))
    assert nothing.where("size(spans) > 0").count() == 0 and nothing.count() == docs.count()
    named = spark.createDataFrame([("x", "Two words!")], "doc_id string, text string")
    assert decontamination.contamination(named, items).first().doc_id == "x"


def test_hot_passage(spark):
    # A passage of a third of all documents, also many times in one.
    passage = " ".join(f"p{i}" for i in range(15))
    docs = [(i, passage if i % 3 == 0 else f"other {i}") for i in range(90)] + [(100, f"{passage} " * 50)]
    items = spark.createDataFrame([(i, passage) for i in range(40)], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in decontamination.contamination(frame, items, at_once=64).collect()}
    assert all([tuple(s) for s in got[i].spans] == [(0, 15)] and len(got[i].items) == 40 for i in range(0, 90, 3))
    assert [tuple(s) for s in got[100].spans] == [(0, 750)]
    assert not any(got[i].spans for i in range(90) if i % 3)
