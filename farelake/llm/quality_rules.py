"""Quality rules with thresholds taken from the corpus itself, per language and source.

1. `measure` counts, per document, what the rules look at.
2. `sketch` sums, per language, source and measure, the documents in each bucket of a log-linear
   integer sketch: values under 64 have a bucket each, larger ones share 32 buckets per power of two
   (relative error 1/32). Sketches merge by adding counts, so the partial aggregation of each task is
   already a sketch, the result does not depend on the order of merging, and a hot source is
   shuffled as a few hundred counts.
3. `thresholds` reads the quartiles from the sketches and sets a fence on each side of them. A source
   with fewer than `min_docs` documents is judged by the merged sketch of its language, a small
   language by that of the corpus.
4. `judge` joins the fences to the measures.

Cases: null text has no words; null language or source is the group of the empty name; documents
without words fail the base rules; repeated rows count as often as they occur; null doc_ids are
passed on; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import WORD_BREAK, let, stored, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "!?.,;:"
MIN_WORDS = 50

#: Measure -> (slack below the fence or None if low values are fine, slack above the fence). The
#: slack keeps ordinary documents of a very uniform source.
RULES = {
    "word_length": (8, 15),  # tenths of characters per word
    "symbols": (None, 30),  # per thousand characters of words
    "marks": (None, 60),  # per thousand characters of words
    "capitals": (None, 120),  # per thousand characters of words
    "dup_lines": (None, 400),  # per thousand lines with a word
    "repeats": (None, 350),  # per thousand words
}
#: The fence stands so many quartile distances beyond the quartile.
REACH = 4


def removed(text: Column, letters: str) -> Column:
    """How many of `letters` the text has."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def repeat_words(tokens: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text, first ones included."""

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 3),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
        )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1), p + 3) - p, F.lit(3))
        )
        return F.aggregate(steps, F.lit(0), lambda total, s: total + s)

    def of_windows(grams: Column) -> Column:
        def of_sorted(order: Column) -> Column:
            def same(x: Column, i: Column) -> Column:
                before, after = F.get(order, i - 1)["g"], F.get(order, i + 1)["g"]
                return F.coalesce(before == x["g"], F.lit(False)) | F.coalesce(after == x["g"], F.lit(False))

            return let(F.sort_array(F.transform(F.filter(order, same), lambda x: x["i"])), covered)

        numbered = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        heavy = let(F.sort_array(numbered), of_sorted)
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), heavy).otherwise(0)

    found = let(let(F.transform(tokens, lambda w: F.xxhash64(w)), windows), of_windows)
    return F.when(F.size(tokens) >= 4, found).otherwise(0)


def measure(docs: DataFrame) -> DataFrame:
    """Counts per document: the base counts and the measures of `RULES`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        text.alias("text"),
        words(text).alias("tokens"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    counted = split.select(
        "doc_id",
        "lang",
        "source",
        F.size("tokens").cast("bigint").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        removed(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("tokens")).cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        removed(F.col("text"), CAPITALS).cast("bigint").alias("n_capitals"),
        removed(F.col("text"), MARKS).cast("bigint").alias("n_marks"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))

    def share(part: str, whole: str, unit: int) -> Column:
        return F.expr(f"({unit} * {part}) div greatest({whole}, 1)")

    return counted.select(
        "*",
        base_failed.alias("base_failed"),
        share("word_chars", "n_words", 10).alias("word_length"),
        share("n_symbols", "word_chars", 1000).alias("symbols"),
        share("n_marks", "word_chars", 1000).alias("marks"),
        share("n_capitals", "word_chars", 1000).alias("capitals"),
        share("n_dup_lines", "n_lines", 1000).alias("dup_lines"),
        share("n_repeat_words", "n_words", 1000).alias("repeats"),
    )


def bucket(value: str) -> str:
    """Lower end of the sketch bucket of a non-negative integer."""
    bits = f"(length(bin({value})) - 6)"
    return f"CASE WHEN {value} < 64 THEN {value} ELSE shiftleft(shiftright({value}, {bits}), {bits}) END"


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, rule, bucket, n): the mergeable sketches, of documents that have words."""
    long = (
        measured.where("n_words > 0")
        .unpivot(["lang", "source"], list(RULES), "rule", "value")
        .selectExpr("lang", "source", "rule", f"{bucket('value')} AS bucket")
    )
    return long.groupBy("lang", "source", "rule", "bucket").agg(F.count(F.lit(1)).alias("n"))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the documents counted, and `<rule>_low` and `<rule>_high` for every rule."""
    by = [*keys, "rule"]
    part = ", ".join(by)
    quartile = (
        sketches.groupBy(*by, "bucket")
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            *by,
            "bucket",
            f"sum(n) OVER (PARTITION BY {part}) AS docs",
            f"sum(n) OVER (PARTITION BY {part} ORDER BY bucket) AS upto",
        )
        .groupBy(*by)
        .agg(
            F.max("docs").alias("docs"),
            F.expr("min(bucket) FILTER (WHERE 4 * upto >= docs)").alias("q1"),
            F.expr("min(bucket) FILTER (WHERE 4 * upto >= 3 * docs)").alias("q3"),
        )
    )
    ends = []
    for rule, (below, above) in RULES.items():
        here = f"FILTER (WHERE rule = '{rule}')"
        if below is not None:
            ends.append(F.expr(f"max(q1 - {REACH} * (q3 - q1) - {below}) {here}").alias(f"{rule}_low"))
        ends.append(F.expr(f"max(q3 + {REACH} * (q3 - q1) + {above}) {here}").alias(f"{rule}_high"))
    return quartile.groupBy(*keys).agg(F.max("docs").alias("docs"), *ends)


def thresholds(sketches: DataFrame, min_docs: int = 200) -> DataFrame:
    """One row per language and source with the fences that hold for it."""
    names = [f"{r}_{side}" for r, ends in RULES.items() for side, e in zip(("low", "high"), ends) if e is not None]
    own = fences(sketches, ["lang", "source"]).alias("own")
    lang = fences(sketches, ["lang"]).alias("lang")
    corpus = fences(sketches, []).select(F.struct(*names)).scalar()
    joined = own.join(lang, F.col("own.lang") == F.col("lang.lang")).withColumn("corpus", corpus)
    return joined.select(
        F.col("own.lang").alias("lang"),
        F.col("own.source").alias("source"),
        *[
            F.when(F.col("own.docs") >= min_docs, F.col(f"own.{n}"))
            .when(F.col("lang.docs") >= min_docs, F.col(f"lang.{n}"))
            .otherwise(F.col(f"corpus.{n}"))
            .alias(n)
            for n in names
        ],
    )


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """The measures with `kept`: the base rules passed and every measure inside its fences."""
    inside = ~F.col("base_failed")
    for rule, (below, _) in RULES.items():
        inside = inside & (F.col(rule) <= F.col(f"{rule}_high"))
        if below is not None:
            inside = inside & (F.col(rule) >= F.col(f"{rule}_low"))
    return measured.join(limits, ["lang", "source"], "left").withColumn("kept", F.coalesce(inside, F.lit(False)))


def quality_rules(docs: DataFrame, min_docs: int = 200) -> DataFrame:
    """Measures, fences and verdict per document. The measures are written once and read twice."""
    measured = stored(measure(docs), "measures")
    return judge(measured, thresholds(sketch(measured), min_docs))
