"""Held-out accuracy, and bundles against plain loops."""

from __future__ import annotations

import numpy as np
from farelake.llm import language_id
from farelake.llm.common import table
from farelake.llm.queries import held_out
from pyspark.sql import functions as F
from samples import awkward, empty


def slow_bundle(text, order, dim, seed):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    spelled = f" {' '.join(letters.split())} "
    padded = f" {spelled.strip()} "
    total = np.zeros(dim)
    for i in range(len(padded) - order + 1):
        bound = np.ones(dim)
        for k, c in enumerate(padded[i : i + order]):
            code = 0 if c == " " else ord(c)
            bound = bound * np.roll(language_id.letter_vector(code, dim, seed), order - 1 - k)
        total += bound
    return total


def test_bundle():
    texts = ["Été, où?", "x", "", "12 ab!! cd\n\nef", "ab ab ab"]
    got = language_id.bundles(texts, 3, 256, 1)
    for text, row in zip(texts, got):
        want = slow_bundle(text, 3, 256, 1) if any(c.isalpha() for c in text) else np.zeros(256)
        assert np.allclose(row, want), text


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("length(text) >= 100")
    profiles = language_id.learn(docs.where(~held_out()))
    found = language_id.identify(docs.where(held_out()), profiles).join(docs, "doc_id")
    right = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert profiles.langs == ["de", "en", "es", "fr"] and right >= 0.97


def test_awkward_rows(spark):
    docs = awkward(spark, "score lang_pred")
    taught = docs.withColumn("lang", F.when(F.col("doc_id") > 5, "xx"))
    profiles = language_id.learn(taught)
    rows = language_id.identify(docs, profiles).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(r.doc_id) for r in docs.collect())
    for r in rows:
        assert r.lang_pred == ("und" if r.doc_id in (1, 2, 3, 7) else r.lang_pred) and 0 <= r.score <= 1
    assert 2**62 + 1 in {r.doc_id for r in rows}
    kept = language_id.with_language(docs, profiles, 0.0)
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0
    nothing = language_id.learn(empty(spark))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(empty(spark), profiles).count() == 0
