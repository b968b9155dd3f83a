"""Sorted suffixes of a sequence of numbers, by doubled prefixes."""

from __future__ import annotations

import numpy as np


def heads(changes: np.ndarray) -> np.ndarray:
    """For every place the last place at or before it where `changes` is set."""
    return np.maximum.accumulate(np.where(changes, np.arange(len(changes)), 0))


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes in order, and whether each differs in its first three numbers from the one before.

    `ids` are not negative, and the last one is found nowhere else. Suffixes that are alone with their
    first three numbers are in place after one sort; only the others are sorted again, by twice as many.
    """
    n, top = len(ids), int(ids.max(initial=0)) + 1
    padded = np.concatenate([ids, np.full(2, ids[-1], dtype=np.int64)])
    if top < 1 << 21:
        key = (padded[:n] << 42) | (padded[1 : n + 1] << 21) | padded[2:]
    else:
        # Too many numbers for three of them in one key: pairs are ranked first.
        _, ranks = np.unique((padded[:-1] << 31) | padded[1:], return_inverse=True)
        key = (ranks[:n] << 31) | padded[2:]
    order = np.argsort(key)
    key = key[order]
    differs = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[order] = heads(differs)
    new, places, depth = differs, np.arange(n), 3
    while True:
        alone = new & np.concatenate([new[1:], [True]])
        places = places[~alone]
        if not len(places):
            return order, differs
        at = order[places]
        key = (rank[at] << 32) | (rank[np.minimum(at + depth, n)] + 1)
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[places] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = places[heads(new)]
        depth *= 2
