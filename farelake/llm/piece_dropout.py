"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is spelled with the space mark of the model and merged pair by pair, best score first, from an
agenda. A candidate merge that comes up is skipped if its keyed hash is below the dropout rate: the key
is the seed and the document, and what is hashed is the candidate, that is the place of its first
character in the text and its length. A skipped candidate does not come up again; other ones may, as
neighbours change. So a word is segmented anew wherever it stands, the pieces are those that merges can
give, and without dropout the ids are those of the library.

No piece of such a model has a space mark after another character, so merges never leave a stretch of
marks and what follows them. As the hash of a candidate depends on nothing that happens elsewhere, the
agendas of all stretches of a batch are processed side by side: a round takes the best candidate of every
stretch that has one, skips or merges it, and scores the new neighbours (`Batch`). Long stretches without
a place where they can be cut are merged one by one, on a heap.

Characters without a piece become bytes, and so does the space mark itself if a text has it: every
text decodes to itself.

Cases: null text gives null ids, empty text no ids; rows that occur twice are encoded alike; with a null
doc_id the text itself is the key; an empty table gives an empty result; other columns are ignored; texts
of any length are encoded whole, some stretches at a time.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import keyed, rekeyed, shipped, tidy
from farelake.llm.shingles import mixed

MARK = "▁"
#: Longer parts are merged on a heap.
SHORT = 48
#: Widths of the agendas that are processed side by side, and how many cells of them at once.
WIDTHS, CELLS = (4, 6, 8, 10, 12, 16, 24, SHORT), 1 << 20
#: Characters of the texts that are encoded together.
TOGETHER = 1 << 20
#: Odd constants that tell places and lengths apart.
AT, LONG = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Stands for a space mark that the text itself has; no text that Spark holds has a lone surrogate.
OWN_MARK = "\udc81"


class Pieces:
    """The vocabulary of a model file and the merges by its scores."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.number, self.score, self.surface = {}, {}, []
        self.byte = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.surface.append(b"")
            else:
                self.number[piece], self.score[piece] = i, model.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        #: Characters that stand side by side in some piece; merges never join any others.
        self.joined = {piece[i : i + 2] for piece in self.number for i in range(len(piece) - 1)}
        if any(MARK in piece.lstrip(MARK) for piece in self.number):
            raise ValueError("pieces with a space mark after another character are not supported")

    def parts(self, stretch: str) -> list[str]:
        """A stretch, cut wherever no merge can reach across."""
        joined = self.joined
        cuts = [i for i, pair in enumerate(map(str.__add__, stretch, stretch[1:]), 1) if pair not in joined]
        if not cuts:
            return [stretch]
        return [stretch[i:j] for i, j in zip([0, *cuts], [*cuts, len(stretch)])]

    def merge(self, part: str, skipped: Callable[[int, str], bool]) -> list[str]:
        """The symbols of a part after all merges; `skipped` is asked for the place and piece of a candidate."""
        return self.merge_short(part, skipped) if len(part) <= SHORT else self.merge_long(part, skipped)

    def ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for symbol in symbols:
            if symbol in self.number:
                out.append(self.number[symbol])
            else:
                out.extend(self.byte[b] for b in symbol.replace(OWN_MARK, MARK).encode())
        return out

    def merge_short(self, stretch: str, skipped: Callable[[int, str], bool]) -> list[str]:
        """The agenda as a plain list of the scores of neighbours; the leftmost of equal ones is first."""
        score, none = self.score, float("-inf")
        symbols = list(stretch)
        agenda = [score.get(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = max(agenda)
            if best == none:
                break
            i = agenda.index(best)
            piece = symbols[i] + symbols[i + 1]
            if skipped(sum(map(len, symbols[:i])), piece):
                agenda[i] = none
                continue
            symbols[i : i + 2] = [piece]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score.get(piece + symbols[i + 1], none)
            if i:
                agenda[i - 1] = score.get(symbols[i - 1] + piece, none)
        return symbols

    def merge_long(self, stretch: str, skipped: Callable[[int, str], bool]) -> list[str]:
        """The agenda as a heap, for stretches of any length."""
        symbols: list[str] = list(stretch)
        count = len(symbols)
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        score, agenda = self.score, []

        def offer(left: int, right: int) -> None:
            piece = symbols[left] + symbols[right]
            if piece in score:
                heapq.heappush(agenda, (-score[piece], left, right, piece))

        for i in range(count - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            # An end may have been merged since.
            if not symbols[left] or not symbols[right] or after[left] != right:
                continue
            if symbols[left] + symbols[right] != piece:
                continue
            if skipped(left, piece):
                continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[left] < count:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: surfaces and bytes, without the mark put before the text."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:]


class Merges:
    """The merges of a vocabulary as arrays: symbols of characters, and what pairs of symbols become.

    Symbols are piece numbers, further numbers for characters that only stand inside of pieces, and
    negative ones for all others, which are never merged.
    """

    def __init__(self, pieces: Pieces) -> None:
        symbol = dict(pieces.number)
        for piece in pieces.number:
            for char in piece:
                symbol.setdefault(char, len(pieces.surface) + len(symbol))
        self.symbol = symbol
        self.of_char = -np.arange(0x110000, dtype=np.int32) - 2
        for char, number in symbol.items():
            if len(char) == 1:
                self.of_char[ord(char)] = number
        found = [
            (symbol[piece[:i]], symbol[piece[i:]], number, pieces.score[piece])
            for piece, number in pieces.number.items()
            for i in range(1, len(piece))
            if piece[:i] in symbol and piece[i:] in symbol
        ]
        left, right, whole, score = zip(*found, strict=True) if found else ((), (), (), ())
        keys = (np.array(left, dtype=np.int64) << 32) | np.array(right, dtype=np.int64)
        # An open table, a quarter full at most: a key stands in its slot or in one of the next.
        self.bits = max(4, (4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size + len(keys) + 1, -1, dtype=np.int64)
        self.whole = np.full(len(self.keys), -1, dtype=np.int32)
        self.score = np.full(len(self.keys), -np.inf, dtype=np.float32)
        for key, slot, made, value in zip(keys.tolist(), self.slot(keys).tolist(), whole, score, strict=True):
            while self.keys[slot] != -1:
                slot += 1
            self.keys[slot], self.whole[slot], self.score[slot] = key, made, value

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * AT) >> np.uint64(64 - self.bits)).view(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of every pair; one with a score of minus infinity where there is no merge."""
        # A negative symbol gives a negative key, which no slot has but the empty ones.
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -1
        slots = self.slot(keys)
        other = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] != -1))
        while len(other):
            slots[other] += 1
            at = slots[other]
            other = other[(self.keys[at] != keys[other]) & (self.keys[at] != -1)]
        return slots


@dataclass(frozen=True)
class Encoder:
    """Encodes texts under a rate and a seed."""

    pieces: Pieces
    merges: Merges
    rate: float
    seed: int
    variant: int

    def encode(self, text: str, name: str | None = None) -> np.ndarray:
        """Ids of a text; the hash is keyed with the name, or else with the variant."""
        return self.encode_all([text], [self.variant if name is None else name])[0]

    def key(self, name: str | int) -> int:
        return xxhash.xxh64_intdigest(f"{self.seed}/{name}".encode("utf-8", "surrogatepass"))

    def skips(self, keys: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Whether the candidates of these lengths at these places of the texts of these keys are skipped."""
        if self.rate <= 0 or self.rate >= 1:
            return np.full(len(keys), self.rate >= 1)
        hashed = mixed(keys + places.astype(np.uint64) * AT + lengths.astype(np.uint64) * LONG)
        return hashed < np.uint64(int(self.rate * (1 << 64)))

    def skipped(self, key: int, start: int) -> Callable[[int, str], bool]:
        """The same for one candidate at a time, of a part that starts at `start`."""

        def asked(place: int, piece: str) -> bool:
            told = np.array([key], dtype=np.uint64), np.array([start + place]), np.array([len(piece)])
            return bool(self.skips(*told)[0])

        return asked

    def encode_all(self, texts: list[str], names: list[str | int]) -> list[np.ndarray]:
        """Ids of every text; as many texts at once as have `TOGETHER` characters."""
        out: list[np.ndarray] = []
        start = held = 0
        for i, text in enumerate(texts):
            held += len(text) + 1
            if held >= TOGETHER or i + 1 == len(texts):
                keys = np.array([self.key(name) for name in names[start : i + 1]], dtype=np.uint64)
                out += Batch(self, texts[start : i + 1], keys).ids()
                start, held = i + 1, 0
        return out


class Batch:
    """The characters of some texts one after the other, and at every place the symbol that starts there."""

    def __init__(self, encoder: Encoder, texts: list[str], keys: np.ndarray) -> None:
        self.encoder, self.merges, self.keys = encoder, encoder.merges, keys
        spelled = "".join([MARK + t.replace(MARK, OWN_MARK).replace(" ", MARK) if t else "" for t in texts])
        self.spelled = spelled
        chars = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.symbols = self.merges.of_char[chars]
        mark = chars == ord(MARK)
        new = mark & ~np.concatenate([[False], mark[:-1]])
        new[self.starts[:-1][sizes > 0]] = True
        self.stretches = np.flatnonzero(new)
        self.lengths = np.diff(np.append(self.stretches, len(chars)))
        owner = np.searchsorted(self.starts, self.stretches, side="right") - 1
        self.key_of, self.place_of = keys[owner], self.stretches - self.starts[owner]

    def ids(self) -> list[np.ndarray]:
        low = 1
        for width in WIDTHS:
            some = np.flatnonzero((self.lengths > low) & (self.lengths <= width))
            for at in range(0, len(some), CELLS // width):
                self.merge(some[at : at + CELLS // width], width)
            low = width
        for i in np.flatnonzero(self.lengths > SHORT).tolist():
            self.merge_alone(int(self.stretches[i]), int(self.lengths[i]), int(self.key_of[i]), int(self.place_of[i]))
        symbols, places = self.symbols, np.flatnonzero(self.symbols != -1)
        symbols = symbols[places]
        owner = np.searchsorted(self.starts, places, side="right") - 1
        pieces = self.encoder.pieces
        strange = np.flatnonzero((symbols < 0) | (symbols >= len(pieces.surface)))
        if len(strange):
            # Characters without a piece are a few ids each.
            spelled = [[pieces.byte[b] for b in self.char(p).encode()] for p in places[strange].tolist()]
            repeats = np.ones(len(symbols), dtype=np.int64)
            repeats[strange] = [len(x) for x in spelled]
            first = np.cumsum(repeats) - repeats
            symbols, owner = np.repeat(symbols, repeats), np.repeat(owner, repeats)
            for at, found in zip(first[strange].tolist(), spelled, strict=True):
                symbols[at : at + len(found)] = found
        return np.split(symbols.astype(np.int32), np.searchsorted(owner, np.arange(1, len(self.starts) - 1)))

    def char(self, place: int) -> str:
        char = self.spelled[place]
        return MARK if char == OWN_MARK else char

    def merge_alone(self, start: int, length: int, key: int, place: int) -> None:
        """A long stretch: cut where no merge reaches across, each part on its own agenda."""
        pieces = self.encoder.pieces
        for part in pieces.parts(self.spelled[start : start + length]):
            symbols = pieces.merge(part, self.encoder.skipped(key, place))
            at = start
            for symbol in symbols:
                self.symbols[at] = self.merges.symbol.get(symbol, self.symbols[at])
                self.symbols[at + 1 : at + len(symbol)] = -1
                at += len(symbol)
            start, place = start + len(part), place + len(part)

    def merge(self, some: np.ndarray, width: int) -> None:
        """The agendas of stretches of at most `width` characters, a candidate of each per round."""
        merges, n = self.merges, len(some)
        # Cells of a stretch are its characters; one more at its end stands for no neighbour.
        wide = width + 1
        cells = self.stretches[some][:, None] + np.arange(wide)
        inside = np.arange(wide) < self.lengths[some][:, None]
        symbol = np.where(inside, self.symbols[np.minimum(cells, len(self.symbols) - 1)], -1).ravel()
        begin = np.arange(n) * wide
        after = (np.arange(n * wide).reshape(n, wide) + 1).ravel()
        before = np.maximum(np.arange(n * wide) - 1, np.repeat(begin, wide))
        size = np.ones(n * wide, dtype=np.int64)
        score = np.full((n, wide), -np.inf, dtype=np.float32)
        made = np.full(n * wide, -1, dtype=np.int32)
        both = np.flatnonzero((inside & np.roll(inside, -1, axis=1) & (np.arange(wide) < width)).ravel())
        slots = merges.pairs(symbol[both], symbol[both + 1])
        score.reshape(-1)[both], made[both] = merges.score[slots], merges.whole[slots]
        flat = score.reshape(-1)
        end = begin + self.lengths[some]
        live, keys, places = np.arange(n), self.key_of[some], self.place_of[some]
        while True:
            agenda = score[live]
            best = agenda.argmax(axis=1)
            found = agenda[np.arange(len(live)), best] > -np.inf
            live, best = live[found], best[found]
            if not len(live):
                break
            at = begin[live] + best
            right = after[at]
            skip = self.encoder.skips(keys[live], places[live] + best, size[at] + size[right])
            flat[at[skip]] = -np.inf
            row, at, right = live[~skip], at[~skip], right[~skip]
            symbol[at] = made[at]
            size[at] += size[right]
            symbol[right], flat[right] = -1, -np.inf
            following = after[right]
            after[at] = following
            last = following >= end[row]
            before[following[~last]] = at[~last]
            flat[at[last]] = -np.inf
            inner, behind = at[~last], following[~last]
            first = at == begin[row]
            previous, me = before[at[~first]], at[~first]
            left, beside = np.concatenate([inner, previous]), np.concatenate([behind, me])
            slots = merges.pairs(symbol[left], symbol[beside])
            flat[left], made[left] = merges.score[slots], merges.whole[slots]
        kept = inside.ravel()
        self.symbols[cells.ravel()[kept]] = symbol[kept]


@lru_cache(maxsize=2)
def open_model(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def open_merges(path: str) -> Merges:
    return Merges(open_model(path))


@lru_cache(maxsize=16)
def remembered(path: str, rate: float, seed: int, variant: int = 0) -> Encoder:
    return Encoder(open_model(path), open_merges(path), rate, seed, variant)


def encode(
    docs: DataFrame, model: str, rate: float = 0.1, seed: int = 1, variants: int | None = None, check: bool = False
) -> DataFrame:
    """doc_id and `ids`, segmented anew for every seed and document.

    With `variants`, the documents share that many keys instead of having one each. `check` adds `lossless`:
    whether the ids decode to the text.
    """
    shipped(docs.sparkSession)

    def name(doc_id: str | None, text: str) -> str:
        if variants is None:
            return f"text/{text}" if doc_id is None else f"doc/{doc_id}"
        return str(0 if doc_id is None else xxhash.xxh64_intdigest(f"{seed}/{doc_id}") % variants)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = remembered(model, rate, seed)
        for frame in frames:
            names = [name(doc_id, text or "") for doc_id, text in zip(frame["doc_id"], frame["text"])]
            found = encoder.encode_all([text or "" for text in frame["text"]], names)
            ids = [None if text is None else made for text, made in zip(frame["text"], found)]
            out = pd.DataFrame({"doc_id": frame["doc_id"], "ids": ids})
            if check:
                decoded = [None if i is None else open_model(model).decode(i) for i in ids]
                out["lossless"] = [a == b for a, b in zip(decoded, frame["text"])]
            yield out

    schema = "doc_id string, ids array<int>" + (", lossless boolean" if check else "")
    return rekeyed(keyed(docs).mapInPandas(tidy(run), schema), docs)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and `text`; null ids give null text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = open_model(model)
        for frame in frames:
            yield frame.assign(
                text=[None if ids is None else pieces.decode(np.asarray(ids, dtype=np.int64)) for ids in frame["ids"]]
            )

    named = encoded.select(F.col("doc_id").cast("string").alias("doc_id"), "ids")
    return rekeyed(named.mapInPandas(run, "doc_id string, ids array<int>, text string"), encoded)
