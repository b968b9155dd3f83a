"""Base counts against brute force; verdicts against labels (the SQL is checked in test_queries)."""

from __future__ import annotations

import re
from collections import Counter

from farelake.llm import quality_rules
from farelake.llm.common import table
from pyspark.sql import functions as F
from samples import awkward, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def test_counts(spark):
    texts = ["a b c a b c", "a a a", "a a a a", "a\nb\na\n \n \na", " \x0bé\U0001d11e x\x0c\r", "a b c " * 5000]
    own = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], awkward(spark).schema)
    docs = awkward(spark).union(own)
    measured = quality_rules.measure(docs.withColumn("tokens", F.lit(1)))
    got = [
        (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in measured.collect()
    ]
    assert sorted(got) == sorted(brute(r.text) for r in docs.collect())


def test_buckets(spark):
    values = [*range(200), 4095, 4096, 123_456_789]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    rows = frame.selectExpr("v", f"{quality_rules.bucket('v')} AS low").collect()
    for v, low in rows:
        assert low == v if v < 64 else low <= v < low * 33 / 32 + 1


def test_awkward_rows_and_empty(spark):
    rows = quality_rules.quality_rules(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_verdicts(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.quality_rules(table(spark, folder, "documents"))
    both = judged.join(table(spark, folder, "labels"), "doc_id").where("NOT base_failed")
    kept = {r.quality: r.share for r in both.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] >= 0.98 and kept.get(0, 0) <= 0.1
