"""Compressed posting lists of a shard in blocks, with what bounds each block's scores.

Documents of a shard have numbers from 0. A posting is a document's number and how often the term occurs in it.
Lists are cut into blocks of ``BLOCK`` postings. A block keeps its first and last number, gaps and counts in as few
bytes as its largest need, and its impacts: the least document length at each count of 1, 2, 3 and from 4 up,
the last with the largest count. They bound the block's scores under any corpus statistics, without unpacking it.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
CLASSES = 4
NONE = np.iinfo(np.uint16).max  # lengths are cut to this, which can only raise a bound
WIDTHS = (np.uint8, np.uint16, np.uint32)


def _width(most: np.ndarray) -> np.ndarray:
    return (most > 255).astype(np.uint8) + (most > 65_535)


def build(terms: np.ndarray, docs: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, n_words: int) -> dict[str, bytes]:
    """Lists of postings that are in order of ``(terms, docs)``; ``lengths`` are terms per document."""
    df = np.bincount(terms, minlength=n_words)
    blocks = -(-df // BLOCK)
    first_of_term = np.cumsum(df) - df
    within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(first_of_term, blocks) + BLOCK * within
    sizes = np.diff(np.r_[starts, len(terms)])
    gaps = np.diff(docs, prepend=0)
    gaps[starts] = 0
    out = {"df": df.astype(np.int32).tobytes()}
    if not len(starts):
        return out | dict.fromkeys(NAMES[1:], b"")
    owner = np.repeat(np.arange(len(starts)), sizes)
    heads = np.zeros(len(terms), bool)
    heads[starts] = True
    gap_width, tf_width = _width(np.maximum.reduceat(gaps, starts)), _width(np.maximum.reduceat(tfs, starts))
    capped = np.minimum(lengths[docs], NONE)
    impacts = np.stack([
        np.minimum.reduceat(np.where(tfs == c if c < CLASSES else tfs >= c, capped, NONE), starts)
        for c in range(1, CLASSES + 1)
    ]).astype(np.uint16)
    most = np.where(tfs >= CLASSES, tfs, 0)
    out |= {
        "firsts": docs[starts].astype(np.int32).tobytes(), "lasts": docs[starts + sizes - 1].astype(np.int32).tobytes(),
        "widths": (gap_width * 4 + tf_width).astype(np.uint8).tobytes(), "impacts": impacts.tobytes(),
        "most": np.maximum.reduceat(most, starts).astype(np.int32).tobytes(),
    }
    for k, kind in enumerate(WIDTHS):
        out[f"gaps{k}"] = gaps[(gap_width[owner] == k) & ~heads].astype(kind).tobytes()
        out[f"tfs{k}"] = tfs[tf_width[owner] == k].astype(kind).tobytes()
    return out


NAMES = ["df", "firsts", "lasts", "widths", "impacts", "most", *(f"{x}{k}" for k in range(3) for x in ("gaps", "tfs"))]


class Lists:
    """Reads what ``build`` made; ``part(tf, length)`` scores a posting without its term's weight."""

    def __init__(self, held: dict[str, bytes], lengths: np.ndarray, part):
        self.lengths, self.part = lengths, part
        df = np.frombuffer(held["df"], np.int32).astype(np.int64)
        blocks = -(-df // BLOCK)
        self.first_block = np.r_[0, np.cumsum(blocks)]
        self.firsts, self.lasts = (np.frombuffer(held[x], np.int32) for x in ("firsts", "lasts"))
        sizes = np.full(len(self.firsts), BLOCK, np.int64)
        tails = self.first_block[1:][df > 0] - 1
        sizes[tails] = (df[df > 0] - 1) % BLOCK + 1
        self.sizes = sizes
        widths = np.frombuffer(held["widths"], np.uint8)
        self.gap_width, self.tf_width = widths // 4, widths % 4
        self.gap_at, self.tf_at = np.zeros((2, len(sizes)), np.int64)
        for k in range(3):
            for at, width, count in ((self.gap_at, self.gap_width, sizes - 1), (self.tf_at, self.tf_width, sizes)):
                mine = np.flatnonzero(width == k)
                at[mine] = np.cumsum(count[mine]) - count[mine]
        self.gaps = [np.frombuffer(held[f"gaps{k}"], kind) for k, kind in enumerate(WIDTHS)]
        self.tfs = [np.frombuffer(held[f"tfs{k}"], kind) for k, kind in enumerate(WIDTHS)]
        self.impacts = np.frombuffer(held["impacts"], np.uint16).reshape(CLASSES, -1)
        self.most = np.frombuffer(held["most"], np.int32)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def blocks(self, term: int) -> tuple[int, int]:
        return int(self.first_block[term]), int(self.first_block[term + 1])

    def bounds(self, blocks: np.ndarray) -> np.ndarray:
        """The most that a posting of each block can score."""
        best = np.zeros(len(blocks), np.int64)
        for c in range(CLASSES):
            least = self.impacts[c, blocks].astype(np.int64)
            tf = np.full(len(blocks), c + 1, np.int64) if c < CLASSES - 1 else self.most[blocks].astype(np.int64)
            # A length of NONE may stand for no posting of this count: the bound is then higher than need be.
            best = np.maximum(best, np.where(tf > 0, self.part(np.maximum(tf, 1), least), 0))
        return best

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of a block, unpacked once."""
        if b not in self.known:
            n, k, j = int(self.sizes[b]), self.gap_width[b], self.tf_width[b]
            docs = np.empty(n, np.int64)
            docs[0] = self.firsts[b]
            docs[1:] = self.gaps[k][self.gap_at[b] : self.gap_at[b] + n - 1]
            docs = np.cumsum(docs)
            tf = self.tfs[j][self.tf_at[b] : self.tf_at[b] + n].astype(np.int64)
            self.known[b] = docs, self.part(tf, self.lengths[docs])
            self.unpacked += 1
        return self.known[b]

    def some(self, blocks) -> tuple[np.ndarray, np.ndarray]:
        held = [self.block(int(b)) for b in blocks]
        if len(held) == 1:
            return held[0]
        return np.concatenate([d for d, _ in held]), np.concatenate([p for _, p in held])
