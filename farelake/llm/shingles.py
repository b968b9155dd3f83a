"""Sets of hashed word shingles, made inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

#: A-Z to a-z; other bytes stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Odd 64-bit constants by which word positions are told apart.
ODD = np.random.default_rng(11).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all of them (the splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word in order. bytes.split() breaks at space and the bytes 9 to 13."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if lower:
        data = data.translate(LOWER)
    return np.array(list(map(xxhash.xxh64_intdigest, data.split())), dtype=np.uint64)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of `size` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        # The position enters by a constant of its own; more positions than constants repeat them rotated.
        total = mixed(total) if k and k % len(ODD) == 0 else total
        total += words[k : k + n] * ODD[k % len(ODD)]
    return mixed(total)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct lower-cased shingles, sorted. Fewer words than `size` make one shingle; none, none."""
    words = word_hashes(text, lower=True)
    if len(words) == 0:
        return words
    if len(words) < size:
        return mixed(window_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(words, size))
