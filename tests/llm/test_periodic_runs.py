"""Runs against a walk over every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from conftest import SMALL
from farelake.llm import periodic_runs
from farelake.llm.common import table
from farelake.llm.queries import QUERIES
from samples import awkward, empty


def brute(words, least=6, exponent=4):
    """Stretches of equal words q apart, for every q; the smallest period of each stretch counts."""
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                best.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((i, length, q) for (i, length), q in best.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id,
        len(runs),
        *(top or (None, None, None)),
        1000 * top[1] // top[2] if top else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def random_words(rng):
    """Words of few kinds, with stretches repeated a whole number of times and a bit, also inside each other."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        part = rng.choices("abc" if rng.random() < 0.7 else "abcdefgh", k=rng.randrange(1, 7))
        if rng.random() < 0.3:
            part = part * rng.randrange(2, 6) + rng.choices("ab", k=rng.randrange(3))
        out += (part * rng.randrange(1, 9))[: rng.randrange(1, 60)]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_random_texts(seed):
    rng = random.Random(seed)
    texts = [[w.encode() for w in random_words(rng)] for _ in range(120)]
    least, exponent = rng.choice([(6, 4), (6, 4), (2, 4), (9, 5)])
    assert periodic_runs.runs_of(texts, least, exponent) == [brute(t, least, exponent) for t in texts]


def test_binary_words_of_every_kind():
    texts = [[b"ab"[(n >> k) & 1 : ((n >> k) & 1) + 1] for k in range(13)] for n in range(1 << 13)]
    assert periodic_runs.runs_of(texts) == [brute(t) for t in texts]


def test_endless_repetition_stays_quick():
    texts = [[b"a"] * 40_000, [b"w%d" % (i % 1000) for i in range(40_000)], [b"x", *[b"y", b"z"] * 20_000]]
    assert periodic_runs.runs_of(texts) == [[(0, 40_000, 1)], [(0, 40_000, 1000)], [(1, 40_000, 2)]]
    # One phrase after ever other words: many leaves of many left words in one interval.
    log = [w for i in range(8_000) for w in (b"%d" % i, b"GET", b"a", b"b", b"c", b"d", b"e", b"f%d" % (i * 7 % 8009))]
    assert periodic_runs.runs_of([log]) == [[]]


def test_awkward_rows_and_empty(spark):
    docs = awkward(spark, "runs start collapsed n_words h g w n")
    found = periodic_runs.digest(periodic_runs.periodic_runs(docs)).collect()
    assert len(found) == docs.count()
    for row, (doc_id, text) in zip(found, [(r.doc_id, r.text) for r in docs.collect()], strict=True):
        assert row.doc_id == doc_id
        if text and len(text) > 1000:  # 20,000 words of period 977
            assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 20_000, 977, 20_470)
        else:
            assert tuple(row)[1:] == expected(None, text)[1:]
    # Small batches give the same rows.
    small = periodic_runs.digest(periodic_runs.periodic_runs(docs, at_once=3)).collect()
    assert small == found
    assert periodic_runs.periodic_runs(empty(spark)).count() == 0
    assert periodic_runs.planted(docs).count() == docs.count()


def test_other_id_types(spark):
    docs = spark.createDataFrame([("a", "x " * 9), (None, None)], "doc_id string, text string")
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert rows["a"].collapsed == "x" and [tuple(r) for r in rows["a"].runs] == [(0, 9, 1)]
    assert rows[None].collapsed == "" and rows[None].n_words == 0


def test_registered_query(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    found = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect())
    short = {r.doc_id for r in docs if len((r.text or "").split()) < 1500}
    want = sorted(expected(r.doc_id, r.text) for r in docs if r.doc_id in short)
    assert [r for r in found if r[0] in short] == want
    assert len(found) == len(docs)
