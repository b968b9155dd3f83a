"""Kept words against a walk over all windows."""

from __future__ import annotations

import hashlib
import itertools
import random

from farelake.llm import substrings
from samples import SCHEMA, awkward, empty


def brute(rows, size):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - size + 1):
            window = tuple(words[at : at + size])
            if window in seen:
                gone[at : at + size] = [True] * size
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def found(frame):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digest(frame).collect()}


def random_rows(seed, count, words, letters):
    rng = random.Random(seed)
    passages = [" ".join(rng.choices(letters, k=rng.randrange(3, 30))) for _ in range(6)]
    rows = []
    for i in range(count):
        parts = [
            rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(letters, k=rng.randrange(words)))
            for _ in range(rng.randrange(1, 4))
        ]
        rows.append((i * 3, " ".join(parts)))
    return rows


def test_random_texts(spark):
    # Few letters: windows repeat everywhere, also overlapping themselves.
    rows = random_rows(1, 60, 25, "abc") + [(500, "a " * 80), (501, "a " * 81)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(substrings.without_repeats(frame, size=8)) == brute(rows, 8)
    # Groups of a few suffixes only, so that prefixes of every length are used.
    assert found(substrings.without_repeats(frame, size=8, group=2)) == brute(rows, 8)


def test_passages(spark):
    rows = random_rows(2, 40, 60, [f"w{i}" for i in range(40)])
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(substrings.without_repeats(frame, size=20)) == brute(rows, 20)


def test_copies_and_a_sharer_in_several_partitions(spark):
    # A text, its exact copy and another text with the same passage, dealt to two or three tasks in every way.
    rng = random.Random(5)
    tasks = [[], [], []]
    for group, places in enumerate(list(itertools.product(range(3), repeat=3)) * 4):
        passage = " ".join(f"g{group}p{i}" for i in range(25))
        ids = [3 * group, 3 * group + 1, 3 * group + 2]
        rng.shuffle(ids)
        for doc_id, text, place in zip(ids, [passage, passage, f"{passage} tail{group}"], places):
            tasks[place].append((doc_id, text))
    rows = [row for task in tasks for row in task]
    dealt = spark.sparkContext.parallelize(tasks, 3).flatMap(lambda task: task)
    frame = spark.createDataFrame(dealt, "doc_id long, text string")
    assert found(substrings.without_repeats(frame, size=20)) == brute(rows, 20)


def test_awkward_rows_and_empty(spark):
    docs = awkward(spark, "copy runs path1 start")
    out = substrings.digest(substrings.without_repeats(docs, size=20)).collect()
    assert len(out) == docs.count()
    known = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    assert {r.doc_id: tuple(r)[1:] for r in out if r.doc_id is not None} == brute(known, 20)
    assert all(r.n_removed == 0 for r in out if r.doc_id is None)
    assert substrings.without_repeats(empty(spark)).count() == 0


def test_remove_repeats(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [
        (1, f"start  {passage} end", "en", None, 1),
        (2, f"other\n{passage} tail", "en", "s", 2),
        (3, passage, None, None, 3),
        (4, "", None, None, None),
        (None, passage, None, None, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in substrings.remove_repeats(frame).collect()}
    assert set(got) == {1, 2, 4, None}
    assert got[1].text == rows[0][1] and got[1].n_chars == 1
    assert got[2].text == "other tail" and got[2].n_chars == 10 and got[2].source == "s"
    assert got[4].text == "" and got[None].text == passage
