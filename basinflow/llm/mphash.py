"""Minimal perfect hashing of whole numbers: every key of a set gets its own number from 0, without gaps.

Keys are hashed into a row of bits, ``ROOM`` times as long as there are keys. A key that is alone in its place sets the bit;
the others go on to a further row with another hash. A key's number is the count of bits set before its own. After
``LEVELS`` rows the few keys left, if any, are listed in order.
"""

from __future__ import annotations

import numpy as np

ROOM, LEVELS = 2, 40


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-spread number of each key."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> dict[str, bytes]:
    """The function for distinct ``keys``."""
    rows, sizes, left = [], [], keys
    while len(left) and len(sizes) < LEVELS:
        size = max(64, -(-ROOM * len(left) // 64) * 64)
        at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        rows.append(np.packbits(alone, bitorder="little"))
        sizes.append(size)
        left = left[~alone[at]]
    return {
        "bits": np.concatenate(rows).tobytes() if rows else b"",
        "sizes": np.asarray(sizes, np.int64).tobytes(), "rest": np.sort(left).tobytes(),
    }


class Function:
    """Numbers of keys. A key outside the set gets any number or -1: compare it with the key kept at that number."""

    def __init__(self, held: dict[str, bytes]):
        self.words = np.frombuffer(held["bits"], np.uint64)
        self.sizes = np.frombuffer(held["sizes"], np.int64)
        self.rest = np.frombuffer(held["rest"], np.int64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    @property
    def n(self) -> int:
        return int(self.before[-1]) + len(self.rest)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for seed, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                return out
            at = base + (mixed(keys[todo], seed) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[here]] = (self.before[at >> 6] + np.bitwise_count(below))[here]
            todo, base = todo[~here], base + size
        if len(todo) and len(self.rest):
            where = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[where] == keys[todo]
            out[todo[found]] = self.before[-1] + where[found]
        return out
