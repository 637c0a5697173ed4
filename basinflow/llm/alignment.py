"""Cross-tokenizer alignment with corpus-wide counts of linked token pairs.

Each text, with a space in front, is encoded by a byte-level BPE (A) and a sentencepiece model (B). Byte offsets where tokens
of both end cut them into groups. Tokens whose byte ranges overlap are linked. A pair's count is the number of
documents that hold it linked.

1. Documents are dealt into chunks of about ``chunk_bytes`` and written one per row, next to the number of their chunk.
2. First pass: a task encodes a chunk, aligns it and sends its distinct pairs with their local counts, dealt into parts by the
   A id. Words stand for themselves in both encodings, so each distinct word of a chunk is encoded and aligned once.
3. Distinct pairs of each part are united along a tree of ``fan`` children and hashed by a minimal perfect function (``mphash``).
   Local counts become dense vectors indexed by the hash, which are summed along the same kind of tree. The keys are
   kept at their numbers, next to the counts and whether a count is its A id's highest.
4. The pairs of each chunk are looked up: number by hash, then compared with the kept key.
5. Second pass: the documents of each chunk meet the counts of its pairs, and are encoded and aligned anew.

A task holds one chunk and a batch of rows, or one part's vectors under one node of a tree; vectors hold the distinct pairs of a part, at
most the size of B's vocabulary for each of its A ids.

Defined results: texts that are null, empty, or whose joined A or B bytes differ from the space and the text have no
tokens: zeros and an empty digest. Rows that share an id are separate documents and count as such. Ids are integers or
null. Further columns are ignored. No documents give no rows. Strings of special tokens are plain text.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinflow.llm import mphash
from basinflow.llm.terms import record_batch, rows_of
from basinflow.session import cut, ship_package


@dataclasses.dataclass(frozen=True)
class Settings:
    chunk_bytes: int = 6_000_000
    part_bytes: int = 256_000_000  # of text per part of the pairs
    fan: int = 64


# Characters that a space may not touch for a text to be cut there, white space and the piece mark.
BLANK = "\t-\r\x1c-\x20\x85\xa0  -     　▁"
CUT = re.compile(f"(?<=[^{BLANK}]) (?=[^{BLANK}])")
TOUCHING = f"^$|^[{BLANK}]|[{BLANK}]$"
# Fixed value: how byte-level vocabularies of this kind cut texts into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LINE = 8_000


class Tokenizers:
    """Both tokenizers with the bytes of their tokens. ``vocabularies`` are the contents of their files."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece

        file = json.loads(a)
        own = _byte_chars()
        words = {i: t for t, i in file["model"]["vocab"].items()}
        self.ranks = _ranks(file, own)
        if self.ranks:
            import tiktoken

            self.a = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=self.ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.a = Tokenizer.from_str(a.decode())
            self.a.no_truncation()
            self.a.no_padding()
            self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.bytes_a = [bytes(own[c] for c in words.get(i, "") if c in own) for i in range(max(words) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(len(self.bytes_b)))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts with a space in front: A adds it, B does so by itself."""
        if self.ranks:
            a = [self.a.encode_ordinary(" " + t) for t in texts]
        else:
            a = [x.ids for x in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)


def _ranks(file: dict, own: dict[str, int]) -> dict[bytes, int] | None:
    """Bytes of A's tokens with their ids, if the file asks for nothing but merges in the order of their ids."""
    vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
    ids = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    cuts = file["pre_tokenizer"] or {}
    if file["normalizer"] or {k: cuts.get(k) for k in plain} != plain or ids != sorted(ids):
        return None
    special = {x["id"] for x in file.get("added_tokens") or []}
    return {bytes(own[c] for c in t): i for t, i in vocabulary.items() if i not in special}


def _byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the
    others, in order, for characters from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@functools.lru_cache(maxsize=2)
def tokenizers(a: bytes, b: bytes) -> Tokenizers:
    return Tokenizers(a, b)


def units(texts: list[str], cuts: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``words, codes, sizes``: texts as numbers of distinct pieces between single spaces, and pieces per text.

    Neither tokenizer joins what such a space divides, if B's vocabulary ``cuts`` there.
    """
    if not cuts:
        whole = pa.array(texts, pa.string()).dictionary_encode()
        return whole.dictionary, whole.indices.to_numpy().astype(np.int64), np.ones(len(texts), np.int64)
    parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
    flat = parts.flatten().dictionary_encode()
    words, codes = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
    sizes = np.diff(parts.offsets.to_numpy()).astype(np.int64)
    touching = pc.match_substring_regex(words, TOUCHING).to_numpy(zero_copy_only=False)[codes]
    if touching.any():
        starts = np.cumsum(sizes) - sizes
        odd = np.flatnonzero(np.add.reduceat(touching, starts) > 0)
        again = [CUT.split(texts[i]) for i in odd.tolist()]
        new = pa.array([u for x in again for u in x], pa.string()).dictionary_encode()
        words = pa.concat_arrays([words, new.dictionary])
        keep = np.ones(len(texts), bool)
        keep[odd] = False
        held = np.split(codes, starts[1:])
        fresh = np.split(new.indices.to_numpy().astype(np.int64) + len(flat.dictionary), np.cumsum([len(x) for x in again])[:-1])
        for i, x in zip(odd.tolist(), fresh):
            held[i] = x
        one = words.dictionary_encode()  # a word may stand in both
        codes = one.indices.to_numpy().astype(np.int64)[np.concatenate(held)]
        words, sizes = one.dictionary, np.fromiter(map(len, held), np.int64, len(held))
        used, codes = np.unique(codes, return_inverse=True)
        words = words.take(pa.array(used))
    return words, codes, sizes


@dataclasses.dataclass
class Aligned:
    """Distinct pieces of text, aligned. Links and groups of a piece are ranges of ``pairs`` and of group borders."""

    good: np.ndarray  # whether the bytes of both came back
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    n_groups: np.ndarray
    pairs: np.ndarray  # A id and B id in one number
    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray  # tokens in front of each group's end
    group_b: np.ndarray


def align(words: list[str], alone: int, t: Tokenizers) -> Aligned:
    """Encode and align pieces of text. The first ``alone`` are encoded one by one, many of the others as one line; where
    a line's bytes do not come back, one by one too."""
    ids_a, ids_b, good, ends = [], [], np.ones(len(words), bool), np.zeros(len(words), np.int64)
    sizes = [len(w.encode()) + 1 for w in words]
    lines, line, length = [[i] for i in range(alone)], [], 0
    for i in range(alone, len(words)):
        line.append(i)
        length += sizes[i]
        if length >= LINE:
            lines.append(line)
            line, length = [], 0
    lines += [line] if line else []
    done = 0
    for start in range(0, len(lines), 50):
        some = lines[start : start + 50]
        for line, a, b in zip(some, *t.encode([" ".join([words[i] for i in x]) for x in some])):
            whole = " " + " ".join([words[i] for i in line])
            tries = [(line, a, b)]
            if not _same(whole, a, b, t):
                own = t.encode([words[i] for i in line])
                tries = [([i], x, y) for i, x, y in zip(line, *own)]
            for mine, x, y in tries:
                if len(tries) > 1 or len(line) == 1:
                    good[mine[0]] = _same(" " + words[mine[0]], x, y, t)
                    if not good[mine[0]]:
                        ends[mine[0]] = done
                        continue
                for i in mine:
                    done += sizes[i]
                    ends[i] = done
                ids_a.append(np.asarray(x, np.int64))
                ids_b.append(np.asarray(y, np.int64))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids_a, ids_b))
    lens_a, lens_b = _lengths(t)
    ends_a, ends_b = np.cumsum(lens_a[a]), np.cumsum(lens_b[b])
    every, twice = _distinct(np.r_[ends_a, ends_b])
    both = every[twice > 1]
    pairs = a[np.searchsorted(ends_a, every)] << 32 | b[np.searchsorted(ends_b, every)]

    def per_word(places: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.searchsorted(places, ends, "right")])

    return Aligned(
        good, per_word(ends_a), per_word(ends_b), per_word(every), per_word(both), pairs, a, b,
        np.searchsorted(ends_a, both, "right"), np.searchsorted(ends_b, both, "right"),
    )


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    ordered = np.sort(values)
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    return ordered[starts], np.diff(np.r_[starts, len(ordered)])


def _lengths(t: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.fromiter(map(len, x), np.int64, len(x)) for x in (t.bytes_a, t.bytes_b))


def _same(text: str, a: list[int], b: list[int], t: Tokenizers) -> bool:
    data = text.encode()
    return b"".join([t.bytes_a[i] for i in a]) == data and b"".join([t.bytes_b[i] for i in b]) == data


class Chunk:
    """Texts of a chunk with their aligned pieces."""

    def __init__(self, texts: list[str | None], t: Tokenizers):
        texts = [x or "" for x in texts]
        words, codes, sizes = units(texts, t.cuts)
        # A space next to a blank divides nothing, so pieces with a blank at an end do not share a line with others.
        alone = np.ones(len(words), bool)
        if t.cuts:
            alone = pc.match_substring_regex(words, TOUCHING).to_numpy(zero_copy_only=False)
        order = np.argsort(~alone, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        self.words, self.codes = words.take(pa.array(order)), place[codes]
        self.doc = np.repeat(np.arange(len(texts)), sizes)
        self.aligned = align(self.words.to_pylist(), int(alone.sum()), t)
        bad = np.bincount(self.doc, ~self.aligned.good[self.codes], len(texts)) > 0
        for i in np.flatnonzero(bad).tolist():  # pieces may fail and their sum hold: ask for the whole text
            bad[i] = not _same(" " + texts[i], *[x[0] for x in t.encode([texts[i]])], t)
        bad |= np.fromiter((not x for x in texts), bool, len(texts))
        self.good = ~bad
        self.n = len(texts)

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums over the pieces of each document, 0 for those without tokens."""
        out = np.zeros(self.n, np.int64)
        if len(self.codes):
            starts = np.searchsorted(self.doc, np.arange(self.n))
            sums = np.r_[0, np.cumsum(values[self.codes])]
            out = np.diff(np.r_[sums[starts], sums[-1]])
        return np.where(self.good, out, 0)

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs in order, and how many documents of the chunk hold each."""
        x = self.aligned
        pairs, number = np.unique(x.pairs, return_inverse=True)
        mine = self.good[self.doc]
        held, _ = _distinct(self.doc[mine] * len(self.words) + self.codes[mine])
        doc, word = held // max(1, len(self.words)), held % max(1, len(self.words))
        n = x.n_links[word]
        starts = np.cumsum(x.n_links) - x.n_links
        at = np.repeat(starts[word] - np.cumsum(n) + n, n) + np.arange(n.sum())
        linked, _ = _distinct(np.repeat(doc, n) * max(1, len(pairs)) + number[at])
        counts = np.bincount(linked % max(1, len(pairs)), minlength=len(pairs))
        return pairs[counts > 0], counts[counts > 0]

    def groups(self) -> Iterator[str]:
        """The groups of each document as text: ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        x = self.aligned
        i, j = np.r_[0, x.group_a[:-1]], np.r_[0, x.group_b[:-1]]
        k, m = x.group_a, x.group_b
        made = np.empty(len(k), object)
        plain = (k - i == 1) & (m - j == 1)
        kinds, number = np.unique(x.a[i[plain]] << 32 | x.b[j[plain]], return_inverse=True)
        made[plain] = np.array([f"{v >> 32}|{v & 0xFFFFFFFF}" for v in kinds.tolist()], object)[number]
        a, b = x.a.tolist(), x.b.tolist()
        for g in np.flatnonzero(~plain).tolist():
            made[g] = f"{','.join(map(str, a[i[g] : k[g]]))}|{','.join(map(str, b[j[g] : m[g]]))}"
        made, ends = made.tolist(), np.cumsum(x.n_groups)
        whole = [";".join(made[v:w]) for v, w in zip((ends - x.n_groups).tolist(), ends.tolist())]
        cuts = np.searchsorted(self.doc, np.arange(self.n + 1)).tolist()
        codes = self.codes.tolist()
        for i in range(self.n):
            yield ";".join([whole[c] for c in codes[cuts[i] : cuts[i + 1]]]) if self.good[i] else ""


PACKS = "leaf long, size long, id long, text string"


def _packed(s: Settings):
    """Documents with the chunk that they start in and their size, row by row: no row and no page holds a chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, at = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            ids, texts = batch.columns
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64) + 16
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            leaf = first + starts // s.chunk_bytes
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(sizes), ids, texts], ["leaf", "size", "id", "text"])

    return run


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of each run of rows of one chunk. A task that reads a part of a chunk's rows takes it for a chunk of its own:
    counts add up all the same."""
    leaf, texts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        leaves = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1], True])
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if leaves[i] != leaf:
                if texts:
                    yield leaf, texts
                leaf, texts = int(leaves[i]), []
            texts += batch.column(1).slice(i, j - i).to_pylist()
    if texts:
        yield leaf, texts


def part_of(pairs: np.ndarray, parts: int) -> np.ndarray:
    """The part that a pair's counts are gathered in; all pairs of an A id go to one."""
    return (mphash.mixed(pairs >> 32, 99) % np.uint64(parts)).astype(np.int64)


LOCAL = "part int, leaf long, pairs binary, counts binary"
LOCAL_ARROW = pa.schema([("part", pa.int32()), ("leaf", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])


def _first_pass(a: bytes, b: bytes, parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, texts in _chunks(batches):
            pairs, counts = Chunk(texts, tokenizers(a, b)).pair_counts()
            part = part_of(pairs, parts)
            yield record_batch([
                {"part": p, "leaf": leaf, "pairs": pairs[part == p].tobytes(),
                 "counts": counts[part == p].astype(np.int32).tobytes()}
                for p in np.unique(part).tolist()
            ], LOCAL_ARROW)

    return run


def _numbers(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for chunk in column.chunks for x in chunk]


def _united(key: tuple, table: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate(_numbers(table.column("pairs"), np.int64)))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "pairs": pa.array([keys.tobytes()], pa.binary())})


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        keys = np.frombuffer(row["pairs"], np.int64)
        made = mphash.build(keys)
        placed = np.empty(len(keys), np.int64)
        placed[mphash.Function(made)(keys)] = keys
        yield record_batch([made | {"part": row["part"], "keys": placed.tobytes()}], HASH_ARROW)


HASH = "part int, bits binary, sizes binary, rest binary, keys binary"
HASH_ARROW = pa.schema([("part", pa.int32()), *((x, pa.binary()) for x in ("bits", "sizes", "rest", "keys"))])
SUMS = "part int, sums binary"


def _one(part: int, sums: np.ndarray) -> pa.Table:
    return pa.table({"part": pa.array([part], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})


def _dense(key: tuple, local: pa.Table, held: pa.Table) -> pa.Table:
    """Local counts under a node as one vector indexed by the hash."""
    number = mphash.Function(held.to_pylist()[0])
    sums = np.zeros(number.n, np.int64)
    for pairs, counts in zip(_numbers(local.column("pairs"), np.int64), _numbers(local.column("counts"), np.int32)):
        sums[number(pairs)] += counts  # distinct pairs, distinct numbers
    return _one(key[0].as_py(), sums)


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    return _one(key[0].as_py(), functools.reduce(np.add, _numbers(table.column("sums"), np.int64)))


COUNTED = HASH + ", sums binary, best binary"
COUNTED_ARROW = pa.schema([*HASH_ARROW, ("sums", pa.binary()), ("best", pa.binary())])


def _judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts next to whether they are their A id's highest."""
    for row in rows_of(batches):
        keys, sums = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["sums"], np.int64)
        order = np.argsort(keys >> 32, kind="stable")
        first = (keys >> 32)[order]
        starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        most = np.repeat(np.maximum.reduceat(sums[order], starts), np.diff(np.r_[starts, len(order)]))
        best = np.empty(len(keys), bool)
        best[order] = sums[order] == most
        yield record_batch([row | {"best": best.tobytes()}], COUNTED_ARROW)


TOLD = "leaf long, pairs binary, sums binary, best binary"
TOLD_ARROW = pa.schema([("leaf", pa.int64()), *((x, pa.binary()) for x in ("pairs", "sums", "best"))])


def _looked_up(key: tuple, local: pa.Table, held: pa.Table) -> pa.Table:
    row = held.to_pylist()[0]
    number = mphash.Function(row)
    keys, sums = np.frombuffer(row["keys"], np.int64), np.frombuffer(row["sums"], np.int64)
    best = np.frombuffer(row["best"], bool)
    out = []
    for leaf, pairs in zip(local.column("leaf").to_pylist(), _numbers(local.column("pairs"), np.int64)):
        at = number(pairs)
        if (at < 0).any() or (keys[at] != pairs).any():
            raise ValueError("a pair of the second pass was not among the first pass's")
        out.append({"leaf": leaf, "pairs": pairs.tobytes(), "sums": sums[at].tobytes(), "best": best[at].tobytes()})
    return pa.Table.from_batches([record_batch(out, TOLD_ARROW)])


DOCS = (
    "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
    "groups string"
)
DOCS_ARROW = pa.schema([
    *((x, pa.int64()) for x in ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
    ("groups_sha256", pa.string()), ("groups", pa.string()),
])


def _second_pass(a: bytes, b: bytes, with_groups: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        chunk = Chunk(docs.column("text").to_pylist(), tokenizers(a, b))
        x = chunk.aligned
        keys, sums, best = (
            np.concatenate([*_numbers(told.column(c), kind), np.zeros(0, kind)])
            for c, kind in (("pairs", np.int64), ("sums", np.int64), ("best", bool))
        )
        order = np.argsort(keys)
        keys, sums, best = (np.r_[v[order], 0] for v in (keys, sums, best))
        at = np.minimum(np.searchsorted(keys[:-1], x.pairs), len(keys) - 1)
        known = keys[at] == x.pairs  # pairs of documents without tokens were not counted
        word = np.repeat(np.arange(len(x.n_links)), x.n_links)
        n = len(x.n_links)
        per_word = {
            "n_a": x.n_a, "n_b": x.n_b, "n_groups": x.n_groups, "n_links": x.n_links,
            "n_best": np.bincount(word, np.where(known, best[at], 0), n).astype(np.int64),
            "count_sum": _sums(np.where(known, sums[at], 0), x.n_links),
        }
        out = {k: chunk.per_doc(v) for k, v in per_word.items()}
        digests, texts = [], []
        for text in chunk.groups():
            digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
            texts.append(text if with_groups else None)
        columns = [docs.column("id"), *map(pa.array, out.values()), pa.array(digests, pa.string())]
        return pa.table([*columns, pa.array(texts, pa.string())], schema=DOCS_ARROW)

    return run


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def counted_pairs(packs: DataFrame, a: bytes, b: bytes, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The chunks' local pairs, and per part the hashed pairs with their corpus-wide counts."""
    leaves, size = packs.agg(F.count_distinct("leaf"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(32, size // s.part_bytes)
    local = cut(packs.select("leaf", "text").mapInArrow(_first_pass(a, b, parts), LOCAL), "local-pairs")
    nodes = max(1, -(-leaves // s.fan))
    node = F.pmod(F.xxhash64("leaf"), F.lit(nodes)).cast("int")
    local = local.withColumn("node", node)

    def up(rows: DataFrame, join, schema: str) -> DataFrame:
        """Join the values of each part under a node, level by level, to one."""
        width = nodes
        while True:
            named = schema + ", node int"
            rows = rows.groupBy("part", "node").applyInArrow(
                lambda key, t: join(key, t).append_column("node", pa.array([key[1].as_py() // s.fan], pa.int32())), named
            )
            if width <= 1:
                return rows.drop("node")
            width = -(-width // s.fan)

    united = up(local.select("part", "node", "pairs"), _united, "part int, pairs binary")
    hashed = cut(united.mapInArrow(_hashed, HASH), "hashed-pairs")
    spread = hashed.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
    dense = local.select("part", "node", "pairs", "counts").groupBy("part", "node").cogroup(
        spread.drop("keys").groupBy("part", "node")
    ).applyInArrow(
        lambda key, x, y: (_dense(key, x, y) if x.num_rows else _one(0, np.zeros(0, np.int64)).slice(0, 0)).append_column(
            "node", pa.array([key[1].as_py()] * min(1, x.num_rows), pa.int32())
        ), SUMS + ", node int",
    )
    sums = up(dense, _summed, SUMS)
    counted = cut(hashed.join(sums, "part").select("part", "bits", "sizes", "rest", "keys", "sums").mapInArrow(
        _judged, COUNTED
    ), "counted-pairs")
    return local, counted.withColumn("nodes", F.lit(nodes))


def _packs(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return cut(rows.mapInArrow(_packed(s), PACKS), "packed-texts")


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def pair_table(
    docs: DataFrame, path_a: str, path_b: str, settings: Settings = Settings(), id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``a, b, count, best`` of each linked pair of ids: documents that hold it, and whether that is the A id's highest."""
    packs = _packs(docs, settings, id_col, text_col)
    _, counted = counted_pairs(packs, _read(path_a), _read(path_b), settings)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys = np.frombuffer(row["keys"], np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(np.frombuffer(row["sums"], np.int64)),
                pa.array(np.frombuffer(row["best"], bool)),
            ], names=["a", "b", "count", "best"])

    return counted.select("keys", "sums", "best").mapInArrow(rows, "a long, b long, count long, best boolean")


def per_document(
    docs: DataFrame, path_a: str, path_b: str, settings: Settings = Settings(), id_col: str = "doc_id",
    text_col: str = "text", with_groups: bool = False,
) -> DataFrame:
    """One row per document: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups``.

    ``n_best`` counts the links whose count is their A id's highest, ``count_sum`` adds the counts over all links. ``groups``
    is null unless asked for.
    """
    s, a, b = settings, _read(path_a), _read(path_b)
    packs = _packs(docs, s, id_col, text_col)
    local, counted = counted_pairs(packs, a, b, s)
    spread = counted.withColumn("node", F.explode(F.sequence(F.lit(0), F.col("nodes") - 1))).drop("nodes")
    none = pa.Table.from_batches([], TOLD_ARROW)
    told = local.select("part", "node", "leaf", "pairs").groupBy("part", "node").cogroup(
        spread.groupBy("part", "node")
    ).applyInArrow(lambda key, x, y: _looked_up(key, x, y) if x.num_rows else none, TOLD)
    docs = packs.select("leaf", "id", "text")
    return docs.groupBy("leaf").cogroup(told.groupBy("leaf")).applyInArrow(_second_pass(a, b, with_groups), DOCS)
