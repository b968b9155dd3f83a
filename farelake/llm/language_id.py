"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram binds its letters: the vectors, each rotated
by its distance from the end, are multiplied. A document bundles (adds) its n-gram vectors, a
language bundles those of all its documents, and a document gets the language whose prototype has the
largest cosine with it. Letter vectors are drawn from a generator seeded with the code point, so
every task makes the same ones and nothing but the prototypes is sent around.

Letters are lower-cased; any run of other characters counts as one gap, also at both ends of a text.

Cases: null text, empty text and text without a letter are `und` with score 0; rows with a null
language teach nothing; if no language was learned, all is `und`; ties go to the first language in
alphabetical order; repeated rows count as often as they occur; null doc_ids are passed on; other
columns are ignored; texts of any length are used whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import hand_back, keyed, rekeyed, tidy

UNKNOWN = "und"
#: Characters handled at once in a task.
BLOCK_CHARS = 400_000
#: Length classes of texts, steps of a cosine, and what a text of a language has to reach.
CLASSES, STEPS, QUANTILE, SLACK = 32, 512, 1 / 1000, 0.8
#: N-gram vectors made at once.
GRAMS = 2_048


@dataclass(frozen=True)
class Profiles:
    """Prototypes of the learned languages, one row each, in alphabetical order of `langs`."""

    langs: list[str]
    prototypes: np.ndarray
    order: int
    seed: int


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case code point of every letter; 0 for every other character."""
    found = np.zeros(0x110000, dtype=np.int32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            found[code] = ord(low) if len(low) == 1 else code
    return found


@lru_cache(maxsize=4096)
def letter_vector(code: int, dim: int, seed: int) -> np.ndarray:
    return (np.random.default_rng([seed, code]).integers(0, 2, dim) * 2 - 1).astype(np.float32)


def grams(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram number, count) of every n-gram of every text, and the letters of each number.

    The fourth array has a row of `order` code points per n-gram number.
    """
    gap = " " * (order - 1)
    sizes = np.array([len(t) + 2 * len(gap) for t in texts])
    joined = "".join(f"{gap}{t}{gap}" for t in texts)
    codes = letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    doc = np.repeat(np.arange(len(texts)), sizes)
    kept = codes != 0
    # Of a run of other characters the first stays.
    kept[1:] |= (codes[:-1] != 0) | (doc[1:] != doc[:-1])
    kept[0] = True
    codes, doc = codes[kept], doc[kept]
    seen = np.flatnonzero(np.bincount(codes))
    slot = np.zeros(int(seen[-1]) + 1, dtype=np.int64)
    slot[seen] = np.arange(len(seen))
    size, n = len(seen), len(codes) - order + 1
    if n <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, np.zeros((0, order), dtype=np.int64)
    number = np.zeros(n, dtype=np.int64)
    for k in range(order):
        number = number * size + slot[codes[k : k + n]]
    inside = doc[:n] == doc[order - 1 :]
    # An n-gram has a letter in it: not all of it is gap.
    letter = np.convolve((codes != 0).astype(np.int64), np.ones(order, dtype=np.int64), "valid") > 0
    number, doc = number[inside & letter], doc[:n][inside & letter]
    span = size**order
    pairs, counts = np.unique(doc * span + number, return_counts=True)
    numbers, column = np.unique(pairs % span, return_inverse=True)
    spelled = np.stack([seen[numbers // size ** (order - 1 - k) % size] for k in range(order)], axis=1)
    return pairs // span, column, counts, spelled


def gram_vectors(spelled: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """The bound vector of every n-gram."""
    codes, place = np.unique(spelled, return_inverse=True)
    place = place.reshape(spelled.shape)
    table = np.stack([letter_vector(int(c), dim, seed) for c in codes])
    order = spelled.shape[1]
    bound = table[place[:, -1]]
    for k in range(order - 1):
        bound *= np.roll(table, order - 1 - k, axis=1)[place[:, k]]
    return bound


def blocks(texts: list[str]) -> Iterator[slice]:
    """Runs of texts with about `BLOCK_CHARS` characters."""
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text)
        if chars >= BLOCK_CHARS:
            yield slice(start, i + 1)
            start, chars = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def bundles(texts: list[str], order: int, dim: int, seed: int) -> np.ndarray:
    """The bundle of every text; zeros without letters."""
    out = np.zeros((len(texts), dim), dtype=np.float32)
    for part in blocks(texts):
        doc, column, counts, spelled = grams(texts[part], order)
        if len(spelled):
            weights = np.zeros((part.stop - part.start, len(spelled)), dtype=np.float32)
            weights[doc, column] = counts
            for at in range(0, len(spelled), GRAMS):
                out[part] += weights[:, at : at + GRAMS] @ gram_vectors(spelled[at : at + GRAMS], dim, seed)
    return out


def learn(docs: DataFrame, dim: int = 1024, order: int = 3, seed: int = 7) -> Profiles:
    """Prototypes from `text` and `lang`. Each task adds up its own; languages x `dim` numbers return."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, group in frame.groupby("lang"):
                texts = group["text"].tolist()
                total = sums.setdefault(lang, np.zeros(dim))
                for part in blocks(texts):
                    _, column, counts, spelled = grams(texts[part], order)
                    if len(spelled):
                        weight = np.bincount(column, counts, len(spelled)).astype(np.float32)
                        for at in range(0, len(spelled), GRAMS):
                            total += weight[at : at + GRAMS] @ gram_vectors(spelled[at : at + GRAMS], dim, seed)
        for lang, total in sums.items():
            yield pd.DataFrame({"lang": lang, "place": np.arange(dim), "value": total})

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    summed = (
        parts.mapInPandas(tidy(partial), "lang string, place int, value double")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    langs = sorted(summed["lang"].unique())
    prototypes = np.zeros((len(langs), dim))
    prototypes[[langs.index(x) for x in summed["lang"]], summed["place"]] = summed["value"]
    return Profiles(langs, prototypes, order, seed)


def predictor(profiles: Profiles) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """From texts to the place of the best language (past the last one for none) and its cosine."""
    lengths = np.linalg.norm(profiles.prototypes, axis=1, keepdims=True)
    unit = (profiles.prototypes / np.maximum(lengths, 1e-300)).astype(np.float32)
    count, order, seed = len(profiles.langs), profiles.order, profiles.seed

    def predict(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        best, score = np.full(len(texts), count), np.zeros(len(texts))
        for part in blocks(texts) if count else ():
            bundle = bundles(texts[part], order, unit.shape[1], seed)
            length = np.linalg.norm(bundle, axis=1)
            cosine = (bundle @ unit.T) / np.maximum(length, 1e-30)[:, None]
            best[part] = np.where(length > 0, cosine.argmax(axis=1), count)
            score[part] = np.where(length > 0, np.clip(cosine.max(axis=1), 0, 1), 0)
        return best, score

    return predict


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, `lang_pred` and `score`, the cosine with the best prototype (0 to 1)."""
    predict, names = predictor(profiles), np.array([*profiles.langs, UNKNOWN], dtype=object)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            best, score = predict(frame["text"].fillna("").tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang_pred": names[best], "score": score})

    return rekeyed(keyed(docs).mapInPandas(tidy(run), "doc_id string, lang_pred string, score double"), docs)


def length_class(text: str) -> int:
    """Texts of one class have half to twice each other's characters; short ones are less like any language."""
    return min(len(text).bit_length(), CLASSES - 1)


def learn_bounds(docs: DataFrame, profiles: Profiles) -> np.ndarray:
    """Per language and length class the cosine that a text of it reaches: `SLACK` times a low quantile of theirs.

    Tasks count the cosines of the documents with a language in `STEPS` steps; the counts add up, so a
    bound moves little by little as documents come, and there is no size at which a rule changes. A class
    without documents takes the bound of the next shorter one that has some.
    """
    predict, count = predictor(profiles), len(profiles.langs)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((count + 1, CLASSES, STEPS), dtype=np.int64)
        for frame in frames:
            texts = frame["text"].tolist()
            best, score = predict(texts)
            step = np.minimum((score * STEPS).astype(np.int64), STEPS - 1)
            np.add.at(table, (best, [length_class(t) for t in texts], step), 1)
        best, size, step = np.nonzero(table)
        yield pd.DataFrame({"best": best, "size": size, "step": step, "n": table[best, size, step]})

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text")
    summed = (
        parts.mapInPandas(tidy(partial), "best int, size int, step int, n long")
        .groupBy("best", "size", "step")
        .agg(F.sum("n").alias("n"))
        .where(F.col("best") < count)
        .toPandas()
    )
    table = np.zeros((count, CLASSES, STEPS))
    table[summed["best"], summed["size"], summed["step"]] = summed["n"]
    bounds = np.zeros((count, CLASSES))
    for lang in range(count):
        for size in range(CLASSES):
            known = table[lang, size].sum()
            below = np.searchsorted(np.cumsum(table[lang, size]), QUANTILE * known, side="right") if known else None
            bounds[lang, size] = bounds[lang, max(size - 1, 0)] if below is None else SLACK * below / STEPS
    return bounds


def with_language(docs: DataFrame, profiles: Profiles, least: float | np.ndarray) -> DataFrame:
    """The documents that have a letter, and a cosine with a learned language of at least `least`, unchanged.

    `least` is one number, or the bounds of `learn_bounds`.
    """
    predict, count = predictor(profiles), len(profiles.langs)
    bounds = np.vstack([np.broadcast_to(np.asarray(least, dtype=float), (count, CLASSES)), np.ones((1, CLASSES))])

    @F.pandas_udf("boolean")
    def known(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            texts = column.fillna("").tolist()
            best, score = predict(texts)
            alike = score >= bounds[best, [length_class(t) for t in texts]]
            yield pd.Series((best < count) & alike)
        hand_back()

    return docs.where(known("text"))
