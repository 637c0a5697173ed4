"""FM-index over word numbers: suffix array, wavelet tree, backward search, sampled positions.

The texts of a shard are one sequence of symbols, 1 and up, each text followed by the symbol 0. These ends
differ from each other in the order of suffixes (the earlier is the smaller), so no common prefix goes beyond a
text. The wavelet tree is stored level by level, highest bit first, zeros of a level before its ones.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order. ``symbols`` ends with a 0."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    value = symbols.astype(np.int64) + len(ends) - 1
    value[ends] = np.arange(len(ends))
    width = int(value.max()).bit_length() if n else 0
    first = max(1, min(3, 63 // max(1, width)))  # as many symbols as one number holds
    key = np.zeros(n, np.int64)
    for i in range(first):
        key <<= width
        key[: n - i] |= value[i:]
    suffixes = np.argsort(key)
    ordered = key[suffixes]
    heads = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, np.int64)
    rank[suffixes] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    single = heads & np.r_[heads[1:], True]
    at = np.flatnonzero(~single)
    depth = first
    while len(at):  # places still shared by suffixes equal up to ``depth``, which reach over no text's end
        here = suffixes[at]
        key = rank[here] * n + rank[here + depth]
        order = np.argsort(key)
        here, key = here[order], key[order]
        suffixes[at] = here
        heads = np.r_[True, key[1:] != key[:-1]]
        rank[here] = np.maximum.accumulate(np.where(heads, at, 0))
        at = at[~(heads & np.r_[heads[1:], True])]
        depth *= 2
    return suffixes


class Bits:
    """A row of bits with the number of ones before each place."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int32)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @staticmethod
    def pack(bits: np.ndarray) -> bytes:
        packed = np.packbits(bits, bitorder="little")
        return np.pad(packed, (0, 8 + -len(packed) % 8)).tobytes()

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        word = at >> 6
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)


def build(symbols: np.ndarray, rate: int) -> dict[str, bytes | int]:
    """The parts of an index over ``symbols``, which ends with a 0; every ``rate``-th place is sampled."""
    n, levels = len(symbols), max(1, int(symbols.max()).bit_length())
    suffixes = suffix_array(symbols)
    last = symbols[suffixes - 1]
    sampled = (suffixes % rate == 0) | (last == 0)  # beginnings of texts too: no walk leaves its text
    bits, zeros, order = [], [], last
    for level in range(levels - 1, -1, -1):
        ones = (order >> level) & 1 == 1
        bits.append(Bits.pack(ones))
        order = np.concatenate([order[~ones], order[ones]])
        zeros.append(n - int(ones.sum()))
    return {
        "n": n, "bits": b"".join(bits), "zeros": np.asarray(zeros, np.int64).tobytes(),
        "sizes": np.bincount(symbols).astype(np.int32).tobytes(),
        "marks": Bits.pack(sampled), "samples": suffixes[sampled].astype(np.int32).tobytes(),
    }


class Index:
    """Searches in what ``build`` made."""

    def __init__(self, parts: dict[str, bytes | int]):
        self.n = parts["n"]
        self.zeros = np.frombuffer(parts["zeros"], np.int64)
        words = np.frombuffer(parts["bits"], np.uint64).reshape(len(self.zeros), -1)
        self.tree = [Bits(level) for level in words]
        sizes = np.frombuffer(parts["sizes"], np.int32)
        self.first = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
        self.marks = Bits(np.frombuffer(parts["marks"], np.uint64))
        self.samples = np.frombuffer(parts["samples"], np.int32)
        symbols = np.arange(len(sizes))
        self.bottom = self._down(symbols, np.zeros(len(symbols), np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places in the last level of the tree that places of the first lead to, as if ``symbols`` stood there."""
        shift = len(self.tree) - 1
        for level, zeros in zip(self.tree, self.zeros):
            ones = level.ones(at)
            at = np.where((symbols >> shift) & 1 == 1, zeros + ones, at - ones)
            shift -= 1
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the last column."""
        return self._down(symbols, at) - self.bottom[symbols]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each row of ``patterns``, found backwards; empty if begin = end.

        Symbols that the index has not got are negative.
        """
        low, high = np.zeros((2, len(patterns)), np.int64)
        high += self.n
        alive = np.flatnonzero((patterns >= 0).all(1))
        high[(patterns < 0).any(1)] = 0
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbols = patterns[alive, column]
            both = self.rank(np.r_[symbols, symbols], np.r_[low[alive], high[alive]])
            low[alive], high[alive] = self.first[symbols] + both.reshape(2, -1)
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes at ``rows``: walk back to the next sampled one."""
        places = np.zeros(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            found = self.marks.get(at) == 1
            places[todo[found]] = self.samples[self.marks.ones(at[found])] + steps
            todo, at = todo[~found], at[~found]
            at = self._back(at)
            steps += 1
        return places

    def _back(self, at: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one symbol longer."""
        symbols = np.zeros(len(at), np.int64)
        for level, zeros in zip(self.tree, self.zeros):
            ones, bit = level.ones(at), level.get(at).astype(np.int64)
            symbols = 2 * symbols + bit
            at = np.where(bit == 1, zeros + ones, at - ones)
        return self.first[symbols] + at - self.bottom[symbols]
