"""An FM-index over numbers: backward search by wavelet-tree ranks, places by sampled suffixes.

The tree over the Burrows-Wheeler transform is stored level by level, highest bit first: a row of bits
per level, with the number of ones before every 64 of them. All searches of a call go down together.
"""

from __future__ import annotations

import io

import numpy as np

from farelake.llm.suffixes import suffix_order

#: Every so many places of the sequence the index keeps one; the others are walked to.
SAMPLED = 16


class Bits:
    """A row of bits that tells how many ones stand before a place."""

    def __init__(self, words: np.ndarray, before: np.ndarray) -> None:
        self.words, self.before = words, before

    @classmethod
    def of(cls, bits: np.ndarray) -> Bits:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(words)
        return cls(words, np.concatenate([[0], np.cumsum(counts[:-1])]).astype(np.int32))

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        at, bit = place >> 6, (place & 63).astype(np.uint64)
        below = self.words[at] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[at] + np.bitwise_count(below).astype(np.int64)

    def get(self, place: np.ndarray) -> np.ndarray:
        return ((self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class FmIndex:
    """Index of a sequence of numbers below `top`; its last number is found nowhere else in it."""

    def __init__(self, levels: list[Bits], zeros: np.ndarray, shift: np.ndarray, first: np.ndarray,
                 marked: Bits, sampled: np.ndarray) -> None:
        self.levels, self.zeros, self.shift, self.first = levels, zeros, shift, first
        self.marked, self.sampled = marked, sampled

    @classmethod
    def build(cls, ids: np.ndarray, top: int) -> FmIndex:
        order, _ = suffix_order(ids)
        row = ids[order - 1]
        counts = np.bincount(ids, minlength=top)
        first = np.concatenate([[0], np.cumsum(counts)])
        levels, zeros = [], []
        for bit in reversed(range(max(1, int(top - 1).bit_length()))):
            ones = (row >> bit) & 1 == 1
            levels.append(Bits.of(ones))
            row = np.concatenate([row[~ones], row[ones]])
            zeros.append(len(row) - int(np.count_nonzero(ones)))
        # Below the last level equal numbers stand together; where each begins there, against its place in order.
        base = np.zeros(top, dtype=np.int64)
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        base[row[starts]] = starts
        marks = order % SAMPLED == 0
        return cls(
            levels, np.array(zeros), (first[:top] - base).astype(np.int64), first.astype(np.int64),
            Bits.of(marks), order[marks].astype(np.int64),
        )

    def step(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the rows before `place` that `number` precedes end, among all suffixes in order."""
        last = len(self.levels) - 1
        at = place
        for depth, bits in enumerate(self.levels):
            ones = bits.ones(at)
            at = np.where((number >> (last - depth)) & 1 == 1, self.zeros[depth] + ones, at - ones)
        return at + self.shift[number]

    def back(self, place: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one place earlier."""
        at, number = place, np.zeros(len(place), dtype=np.int64)
        for depth, bits in enumerate(self.levels):
            ones, bit = bits.ones(at), bits.get(at)
            at = np.where(bit == 1, self.zeros[depth] + ones, at - ones)
            number = (number << 1) | bit
        return at + self.shift[number]

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of one length (rows) that occur: their row numbers, and the range of their suffixes."""
        which = np.arange(len(phrases))
        last = phrases[:, -1]
        low, high = self.first[last], self.first[last + 1]
        for column in reversed(range(phrases.shape[1] - 1)):
            found = low < high
            which, low, high = which[found], low[found], high[found]
            if not len(which):
                break
            number = phrases[which, column]
            ends = self.step(np.concatenate([number, number]), np.concatenate([low, high]))
            low, high = ends[: len(which)], ends[len(which) :]
        found = low < high
        return which[found], low[found], high[found]

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the sequence of all suffixes of the ranges, and which range each belongs to."""
        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
        places = np.zeros(len(rows), dtype=np.int64)
        open_ones, steps = np.arange(len(rows)), 0
        while len(open_ones):
            known = self.marked.get(rows) == 1
            places[open_ones[known]] = self.sampled[self.marked.ones(rows[known])] + steps
            open_ones = open_ones[~known]
            rows = self.back(rows[~known])
            steps += 1
        return places, owner

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out,
            words=np.array([b.words for b in self.levels]),
            before=np.array([b.before for b in self.levels]),
            zeros=self.zeros, shift=self.shift, first=self.first,
            marked_words=self.marked.words, marked_before=self.marked.before, sampled=self.sampled,
        )
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> FmIndex:
        with np.load(io.BytesIO(data)) as held:
            levels = [Bits(w, b) for w, b in zip(held["words"], held["before"], strict=True)]
            return cls(levels, held["zeros"], held["shift"], held["first"],
                       Bits(held["marked_words"], held["marked_before"]), held["sampled"])
