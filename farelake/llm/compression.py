"""Quality by compression: which of two dictionaries makes a text smaller.

Raw dictionaries are made of good and of bad labelled text. A text is compressed with each one, in
blocks of a fixed size so that the dictionary counts for the whole text and not only for its start.
The difference of the compressed sizes, by the size of the text, is the feature: by the sum of the
compressed sizes, the few bytes that are left of endless repetition would weigh as much as prose. A
logistic curve, fitted to labelled texts that the dictionaries have not seen and weighted to the
shares of the labels, turns the feature into a score: each half of the sample is compared with the
dictionaries of the other half, and the dictionaries of the whole sample are the ones that stay.

The sample is bounded: of each label the `sample` rows whose doc_ids hash lowest. The driver gets 1,024
bytes from the middle of each, and one number per text; the texts themselves, however long, are compared
in tasks.

Cases: null and empty texts get the score of equal sizes; rows without a label or text teach nothing;
without labels of both kinds all scores are the share of good labels (one half without labels);
repeated rows are scored alike; null doc_ids are passed on; a document with both labels teaches one of
them, label 0; very long texts are compared whole, block by block; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import keyed, rekeyed, stored, tidy

#: Labelled rows of each kind that are used at most.
SAMPLE = 2_000
#: Bytes of a text that go into a dictionary of many texts, of a dictionary, and of a block of a text.
PART, DICTIONARY, PIECE = 1_024, 1 << 19, 512


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    middle: float


@lru_cache(maxsize=8)
def compressor(content: bytes) -> zstandard.ZstdCompressor:
    raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=3)
    return zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False)


def size(content: bytes, data: bytes) -> int:
    """Bytes of the compressed blocks of a text."""
    made = compressor(content)
    return sum(len(made.compress(data[at : at + PIECE])) for at in range(0, len(data), PIECE))


def feature(model: Model, text: str | None) -> float:
    """Above zero if the good dictionary makes the text smaller."""
    data = (text or "").encode("utf-8", "surrogatepass")
    good, bad = size(model.good, data), size(model.bad, data)
    return (bad - good) / len(data) if data else 0.0


def middle_of(text: Column) -> Column:
    """`PART` bytes from the middle of a text."""
    data = F.encode(text, "utf-8")
    start = F.greatest(F.lit(0), F.floor((F.octet_length(text) - PART) / 2)).cast("int")
    return F.substring(data, start + 1, F.lit(PART))


def dictionary(parts: list[bytes]) -> bytes:
    """The stretches of the texts, the first ones last, where they are cheapest to refer to."""
    taken, total = [], 0
    for part in parts:
        taken.append(part)
        total += len(part)
        if total >= DICTIONARY:
            break
    return b"\n".join(reversed(taken))[-DICTIONARY:]


def curve(x: np.ndarray, good: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and middle of the likeliest logistic curve, lightly regularised, for a `share` of good rows."""
    scale = max(x.std(), 1e-6)
    z = x / scale
    w = np.zeros(2)
    rows = np.stack([z, np.ones_like(z)], axis=1)
    weight = np.where(good == 1, share / max(good.mean(), 1e-6), (1 - share) / max(1 - good.mean(), 1e-6))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (weight * (good - p)) - 1e-2 * w
        bend = rows.T @ (rows * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        w = w + np.linalg.solve(bend, slope)
    return float(w[0] / scale), float(-w[1] * scale / w[0]) if w[0] else 0.0


def trimmed(one: bytes, other: bytes) -> tuple[bytes, bytes]:
    """Dictionaries of one size, so that neither gains by knowing more."""
    least = min(len(one), len(other))
    return one[len(one) - least :], other[len(other) - least :]


def features(texts: DataFrame, turn: dict, halves: list[Model]) -> pd.DataFrame:
    """doc_id, quality and the feature `x` of the sampled texts, each by the dictionaries of the other half."""
    sent = texts.sparkSession.sparkContext.broadcast((turn, halves))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        halves_of, models = sent.value
        for frame in frames:
            x = [feature(models[halves_of[i]], text) for i, text in zip(frame["doc_id"], frame["text"], strict=True)]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"], "x": np.array(x, dtype=float)})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name != "text")
    return texts.mapInPandas(tidy(compare), f"{kinds}, x double").toPandas()


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit to `text` and `quality`, joined by doc_id."""
    known = labels.where("quality IN (0, 1)").select("doc_id", "quality").distinct()
    share = known.agg(F.avg("quality")).first()[0]
    lowest = []
    for kind in (0, 1):
        rows = known.where(F.col("quality") == kind)
        lowest.append(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    picked = lowest[0].union(lowest[1])
    # At most twice `sample` doc_ids: small enough to send to every task.
    rows = docs.where("text IS NOT NULL AND text <> ''").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Of repeated rows the smallest text counts. What the driver gets is `PART` bytes of each.
    texts = stored(rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "labelled")
    found = texts.select("doc_id", "quality", middle_of(F.col("text")).alias("part")).toPandas()
    found = found.sort_values(["doc_id", "quality"]).drop_duplicates("doc_id").reset_index(drop=True)
    order = np.random.default_rng(1).permutation(len(found))
    content, quality = [bytes(part) for part in found["part"]], found["quality"].to_numpy()

    def dictionaries(rows: np.ndarray) -> Model | None:
        good, bad = (dictionary([content[i] for i in rows if quality[i] == kind]) for kind in (1, 0))
        return Model(*trimmed(good, bad), 1.0, 0.0) if good and bad else None

    def unknown() -> Model:
        """Nothing to tell good and bad apart: the share of good labels is all that is known."""
        usual = min(max(0.5 if share is None else share, 0.01), 0.99)
        return Model(b"", b"", 0.0, float(np.log(usual / (1 - usual))))

    # Every second row of each label, so that both halves have both.
    turn = np.zeros(len(found), dtype=np.int64)
    for kind in (0, 1):
        mine = order[quality[order] == kind]
        turn[mine] = np.arange(len(mine)) % 2
    halves = [dictionaries(order[turn[order] != half]) for half in (0, 1)]
    if None in halves:
        return unknown()
    # Whole texts are compared where they are; a number per text comes back.
    x = features(texts, dict(zip(found["doc_id"].tolist(), turn.tolist(), strict=True)), halves)
    compared = found.merge(x, on=["doc_id", "quality"])
    slope, middle = curve(compared["x"].to_numpy(), compared["quality"].to_numpy(dtype=float), share)
    whole = dictionaries(order)
    return Model(whole.good, whole.bad, slope, middle)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and `score`, the estimated chance of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = sent.value
        for frame in frames:
            if fitted.good:
                x = np.array([feature(fitted, text) for text in frame["text"]], dtype=float)
                power = fitted.slope * (x - fitted.middle)
            else:
                power = np.full(len(frame), fitted.middle)
            chance = 1 / (1 + np.exp(-np.clip(power, -30, 30)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": chance})

    return rekeyed(keyed(docs).mapInPandas(judge, "doc_id string, score double"), docs)
