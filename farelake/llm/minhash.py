"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. `signatures`: per document the size of its shingle set, a 128-bit name of the set, a key per band
   of minima, and the low bits of all minima, packed.
2. Documents with equal sets are one class, represented by the smallest doc_id, so copies never meet.
3. Representatives that share a band key are candidates. No group emits all its pairs: at first every
   member of a bucket meets the smallest one, and the smallest one of a salted part of the bucket,
   which is another one in every band. The pairs are thinned by the sizes of the sets and by the
   similarity estimated from the packed bits (equal bits, corrected for those equal by chance), then
   confirmed. What is linked by then is one component.
   In a second pass, every stray, a member outside a bucket's largest component, meets the members of
   that bucket, so that any two of them were either compared or are connected. Before that, shingles
   that no other open document has are counted: a set with too many of them cannot link at all, which
   ends most strays of a large group without comparing them. The others meet lot by lot; a task gives
   back links, not pairs.
4. `confirm` compares the full sets.

With 32 bands of 4 minima a pair of similarity 0.80 shares a band but for 5 in 10^8 cases, one of
0.85 but for 5 in 10^11; the estimate rejects six standard deviations below the threshold.

Cases: null and empty texts have no shingles and link with nothing; rows of one doc_id are one
document; rows with a null doc_id link with nothing (component null, kept); an empty table gives an
empty result; other columns are ignored; texts are used whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import keyed, narrowed, rekeyed, stored, tidy
from farelake.llm.components import components
from farelake.llm.shingles import shingle_set

BANDS, ROWS, BITS = 32, 4, 2
MINIMA = BANDS * ROWS
#: Longs that hold the low bits of all minima.
LONGS = MINIMA * BITS // 64
#: Members of a bucket's salted parts, about.
MEET = 8
#: Strays and members of a large group that meet in one task, about.
FEW, MANY = 128, 2_000
#: Six standard deviations of the estimated similarity, at 0.8.
MARGIN = 0.25


def minima(shingles: np.ndarray, seed: int = 5) -> np.ndarray:
    """The smallest value of a set under each of the hash functions (32 bits each)."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
    best = np.full(MINIMA, (1 << 32) - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        values = (shingles[at : at + 512, None] * factor + shift) >> np.uint64(32)
        best = np.minimum(best, values.min(axis=0))
    return best.astype(np.uint32)


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima as 64-bit numbers."""
    bits = (low[:, None] >> np.arange(BITS, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").view("<i8")


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_hi, set_lo, bands and bits; the last four null for empty sets."""

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                shingles = shingle_set(text, words)
                if len(shingles) == 0:
                    rows.append((doc_id, 0, None, None, None, None))
                    continue
                name = xxhash.xxh128_digest(shingles.tobytes())
                high, low = np.frombuffer(name, dtype="<i8")
                smallest = minima(shingles)
                bands = [
                    xxhash.xxh64_intdigest(band.tobytes(), seed=k) - (1 << 63)
                    for k, band in enumerate(smallest.reshape(BANDS, ROWS))
                ]
                rows.append((doc_id, len(shingles), high, low, bands, packed(smallest)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_hi", "set_lo", "bands", "bits"])
            yield out.astype({"set_hi": "Int64", "set_lo": "Int64"})

    schema = "doc_id string, n_shingles long, set_hi long, set_lo long, bands array<long>, bits array<long>"
    return rekeyed(keyed(docs).mapInPandas(tidy(sign), schema), docs)


def estimated(left: str, right: str) -> Column:
    """Similarity from packed low bits: the share of equal minima, corrected for equality by chance."""
    lane = sum(1 << at for at in range(0, 64, BITS)) - (1 << 64 if BITS == 1 else 0)
    different = F.lit(0)
    for k in range(LONGS):
        apart = F.get(left, F.lit(k)).bitwiseXOR(F.get(right, F.lit(k)))
        folded = apart
        for shift in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(apart, shift))
        different = different + F.bit_count(folded.bitwiseAND(F.lit(lane)))
    equal = 1 - different / F.lit(float(MINIMA))
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def thinned(pairs: DataFrame, reps: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs that sizes and estimate allow to reach part / whole."""
    left = reps.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("bits").alias("bits_a"))
    right = reps.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("bits").alias("bits_b"))
    size = whole * F.least("n_a", "n_b") >= part * F.greatest("n_a", "n_b")
    near = estimated("bits_a", "bits_b") >= part / whole - MARGIN
    return pairs.join(left, "a").join(right, "b").where(size & near).select("a", "b").distinct()


def own_shingles(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """doc_id and `own`, the shingles that no other of these documents has, for those that have any.

    `ids` names each document once.
    """

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [shingle_set(text, words).view(np.int64) for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "shingles": made})

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = narrowed(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), ids)
    # No semi-join: Spark moves that one below the join of `narrowed`, and then every text is shuffled.
    each = texts.join(ids, "doc_id").select("doc_id", "text").mapInPandas(tidy(sets), f"doc_id {kind}, shingles array<long>")
    having = each.select("doc_id", F.explode("shingles").alias("shingle")).groupBy("shingle")
    ends = having.agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("other")).where("doc_id = other")
    return ends.groupBy("doc_id").agg(F.count(F.lit(1)).alias("own"))


def linked(few: pd.DataFrame, many: pd.DataFrame, words: int, part: int, whole: int) -> pd.DataFrame:
    """Links between two bounded lots of documents, from an index of the shingles of the first."""
    few = few.drop_duplicates("doc_id")
    sets = [shingle_set(text, words) for text in few["text"]]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    shingles = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    ids, out = few["doc_id"].to_numpy(), []
    for doc_id, text in zip(many["doc_id"], many["text"]):
        own = shingle_set(text, words)
        first, last = np.searchsorted(shingles, own, "left"), np.searchsorted(shingles, own, "right")
        count = last - first
        place = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(owner[place], minlength=len(sets))
        near = ids[(both > 0) & (whole * both >= part * (sizes + len(own) - both))]
        out.extend((doc_id, other) for other in near if other != doc_id)
    return pd.DataFrame(out, columns=["a", "b"])


def remaining(docs: DataFrame, open_: DataFrame, reps: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """Links (a, b) between documents of different components in one bucket.

    The buckets of one component are taken together. Its strays are dealt into lots of `FEW`, its
    members into lots of `MANY`, and each lot of strays meets each lot of members in a task of its
    own, which compares full sets and gives back links only.
    """
    ids = open_.select("doc_id").distinct()
    facts = (
        reps.join(ids, "doc_id", "left_semi")
        .join(own_shingles(docs, ids, words), "doc_id", "left")
        .where(whole * (F.col("n_shingles") - F.coalesce("own", F.lit(0))) >= part * F.col("n_shingles"))
        .select("doc_id")
        .distinct()
    )
    # A document with more shingles of its own than a link allows is ruled out here.
    hopeful = stored(
        open_.join(facts, "doc_id").select("most", "doc_id", (F.col("label") != F.col("most")).alias("stray")).distinct(),
        "open",
    )
    sizes = hopeful.groupBy("most").agg(
        F.ceil(F.count_if("stray") / FEW).cast("int").alias("few"), F.ceil(F.count(F.lit(1)) / MANY).cast("int").alias("many")
    )
    dealt = hopeful.join(sizes.where("few > 0"), "most")
    spread = F.xxhash64("doc_id")

    def lots(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    strays = dealt.where("stray").select(
        "most", F.pmod(spread, F.col("few")).cast("int").alias("f"), lots("many").alias("m"), "doc_id"
    )
    members = dealt.select(
        "most", lots("few").alias("f"), F.pmod(spread, F.col("many")).cast("int").alias("m"), "doc_id"
    )

    wanted = narrowed(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), dealt.select("doc_id"))

    def unit_of(lot: DataFrame) -> DataFrame:
        # Names of its own for either side, which come from the same frames.
        return wanted.join(lot, "doc_id").select(*[F.col(c).alias(c) for c in ("most", "f", "m", "doc_id", "text")])

    def run(few: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        return linked(few, many, words, part, whole)

    kind = docs.schema["doc_id"].dataType.simpleString()
    few, many = (unit_of(lot).groupBy("most", "f", "m") for lot in (strays, members))
    return few.cogroup(many).applyInPandas(run, f"a {kind}, b {kind}")


def confirm(docs: DataFrame, pairs: DataFrame, words: int, part: int, whole: int) -> DataFrame:
    """Pairs whose full sets reach part / whole. The set of `b` travels to the text of `a`."""

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [shingle_set(text, words).tobytes() for text in frame["text"]]
            yield pd.DataFrame({"a": frame["a"], "b": frame["doc_id"], "set_b": made})

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, own = None, None
        for frame in frames:
            linked = []
            for text, other in zip(frame["text"], frame["set_b"]):
                if text != last:
                    last, own = text, shingle_set(text, words)
                theirs = np.frombuffer(other, dtype=np.uint64)
                both = len(np.intersect1d(own, theirs, assume_unique=True))
                linked.append(whole * both >= part * (len(own) + len(theirs) - both))
            yield frame.loc[linked, ["doc_id", "b"]].rename(columns={"doc_id": "a"})

    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    texts = narrowed(docs.select("doc_id", "text").where("doc_id IS NOT NULL"), ids)
    kind = docs.schema["doc_id"].dataType.simpleString()
    with_b = texts.join(pairs.withColumnRenamed("b", "doc_id"), "doc_id").mapInPandas(
        tidy(sets), f"a {kind}, b {kind}, set_b binary"
    )
    with_a = texts.join(with_b.withColumnRenamed("a", "doc_id"), "doc_id")
    return with_a.select("doc_id", "text", "b", "set_b").mapInPandas(tidy(compare), f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, one row per row of `docs`.

    Documents link if whole * |intersection| >= part * |union| of their shingle sets.
    """
    signed = stored(signatures(docs, words), "signatures")
    named = signed.where("set_hi IS NOT NULL AND doc_id IS NOT NULL")
    classes = named.groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("rep"))
    reps = stored(named.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), "classes")

    members = reps.select("doc_id", F.explode("bands").alias("bucket"))
    sized = members.groupBy("bucket").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count(F.lit(1)).alias("size")
    )
    part_of = F.pmod(F.xxhash64("doc_id", "bucket"), F.ceil(F.col("size") / MEET)).alias("salt")
    shared = stored(
        members.join(sized.where("a < z").select("bucket", "a", "size"), "bucket").select("*", part_of), "buckets"
    )
    nearby = shared.groupBy("bucket", "salt").agg(F.min("doc_id").alias("p"))
    met = shared.join(nearby, ["bucket", "salt"]).select(F.explode(F.array("a", "p")).alias("a"), F.col("doc_id").alias("b"))
    met = met.where("a < b").distinct()
    links = stored(confirm(docs, thinned(met, reps, part, whole), words, part, whole), "links")
    joined = stored(components(links), "components")

    labelled = shared.join(joined, shared["doc_id"] == joined["node"], "left").select(
        "bucket", "doc_id", F.coalesce("component", "doc_id").alias("label")
    )
    counted = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = (
        counted.groupBy("bucket")
        .agg(F.max_by("label", "n").alias("most"), F.count(F.lit(1)).alias("labels"))
        .where("labels > 1")
        .select("bucket", "most")
    )
    open_ = stored(labelled.join(mixed, "bucket"), "open")
    rest = stored(remaining(docs, open_, reps, words, part, whole), "links")
    if not rest.isEmpty():
        joined = stored(components(links.union(rest)), "components")

    final = classes.join(joined, classes["rep"] == joined["node"], "left").select(
        "set_hi", "set_lo", F.coalesce("component", "rep").alias("found")
    )
    component = F.coalesce("found", "doc_id")
    return signed.join(final, ["set_hi", "set_lo"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
