"""Byte-level BPE, encoding and decoding, with a vocabulary file of the tokenizers library.

A text is cut at the file's special tokens, then by the byte-level pattern. Within each piece the
adjacent pairs stand as leaves of a segment tree by (rank, place): its root is the leftmost pair of
lowest rank. Merging that pair updates three leaves, each in logarithmic time, until the root holds
no mergeable pair. So a piece of n bytes takes n log n steps, also when it is one very long word.
The trees of many short pieces stand side by side in arrays and are worked on
together; their ids are remembered, up to a bound, for pieces recur. Remembered pieces are numbered and their ids
lie one after the other in one array, so the ids of many texts are gathered at once from the numbers of their pieces.

Defined results: a null text is encoded as empty, to no ids; null ids decode to null, as do null
entries' rows; ids outside the vocabulary are skipped in decoding, and bytes that are not UTF-8 become
U+FFFD. Rows are independent: repeated rows, null ids of rows and further columns do no harm. Other columns are
not returned. No rows give no rows.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinflow.session import ship_package

# Fixed value: the pattern of byte-level pre-tokenisation.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
NONE = 1 << 62
PLACE = (1 << 32) - 1
REMEMBERED = 500_000  # pieces kept per Python worker
SHORT = 65  # bytes of a piece up to which trees are worked on together
LONG_TEXT = 1_000_000  # characters from which a text's pieces are not listed at once


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _gather(flat: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen of the pieces that lie in ``flat`` between ``ends``, one after the other, and where each ends."""
    starts = ends[numbers]
    sizes = ends[numbers + 1] - starts
    until = np.cumsum(sizes)
    return flat[np.repeat(starts - until + sizes, sizes) + np.arange(sizes.sum())], until


class _Numbers(dict):
    """Numbers of pieces; one that is not known gets the next number and is noted as new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


@functools.cache
def _plain_pattern(limit: int) -> re.Pattern:
    """The pattern for texts whose code points are below ``limit``, with its classes listed for the quicker ``re``."""
    every = "".join(map(chr, range(limit)))
    spans = {
        kind: "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in regex.finditer(kind + "+", every))
        for kind in (r"\p{L}", r"\p{N}", r"\s")
    }
    l, n, s = spans.values()
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{l}]+| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+")


BEYOND = re.compile("[\U00010000-\U0010ffff]")


class Tokenizer:
    """What a vocabulary file says, ready for use in one process."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model, pre = spec["model"], spec["pre_tokenizer"]
        added = spec.get("added_tokens") or []
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("not a byte-level BPE vocabulary")
        if pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("unsupported pre-tokeniser settings")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("unsupported special tokens")
        vocab = model["vocab"]
        letters = _byte_letters()
        self.first = [vocab[c] for c in letters]
        self.width = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        self.pairs, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[left] * self.width + vocab[right]] = rank
            self.merged.append(vocab[left + right])
        byte_of = {c: b for b, c in enumerate(letters)}
        self.bytes = [b""] * self.width
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in added}
        for token, i in self.special.items():
            self.bytes[i] = token.encode("utf-8")
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.pattern = regex.compile(PATTERN)
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.ranks = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        self.merged_ids = np.array(self.merged, np.int64)
        self.first_ids = np.array(self.first, np.int64)
        self.table = pa.array(self.bytes, pa.binary())
        self._forget()

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.first[b] for b in data]
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, merged, width = self.pairs.get, self.merged, self.width
        size = 1 << (n - 2).bit_length()
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            rank = rank_of(symbols[i] * width + symbols[i + 1])
            if rank is not None:
                tree[size + i] = rank << 32 | i
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            node = size + leaf
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        while tree[1] < NONE:
            i = tree[1] & PLACE
            symbols[i] = merged[tree[1] >> 32]
            gone = after[i]
            right = after[i] = after[gone]
            if gone < n - 1:
                put(gone, NONE)
            symbols[gone] = -1
            value = NONE
            if right < n:
                before[right] = i
                rank = rank_of(symbols[i] * width + symbols[right])
                if rank is not None:
                    value = rank << 32 | i
            put(i, value)
            left = before[i]
            if left >= 0:
                rank = rank_of(symbols[left] * width + symbols[i])
                put(left, NONE if rank is None else rank << 32 | left)
        return [s for s in symbols if s >= 0]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, NONE where a pair does not merge."""
        if not len(self.keys):
            return np.full(left.shape, NONE)
        pair = left * self.width + right
        at = np.searchsorted(self.keys, pair).clip(max=len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == pair), self.ranks[at] << 32, NONE)

    def _merge_trees(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` for pieces of at most ``size + 1`` bytes, one row of the arrays for each: all ids and how many of each."""
        m = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, m)
        symbols = np.full((m, size + 2), -1)
        symbols[np.arange(size + 2) < length[:, None]] = self.first_ids[
            np.frombuffer(b"".join(pieces), np.uint8)
        ]
        rank = self._rank_of(symbols[:, :-2], symbols[:, 1:-1])
        levels = [np.where(rank < NONE, rank | np.arange(size), NONE)]
        while levels[-1].shape[1] > 1:
            levels.append(np.minimum(levels[-1][:, ::2], levels[-1][:, 1::2]))
        after = np.tile(np.arange(1, size + 3), (m, 1))
        before = np.tile(np.arange(-1, size + 1), (m, 1))

        def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray | int) -> None:
            levels[0][row, leaf] = value
            for low, high in zip(levels, levels[1:]):
                leaf = leaf >> 1
                high[row, leaf] = np.minimum(low[row, 2 * leaf], low[row, 2 * leaf + 1])

        row = np.arange(m)
        while True:
            root = levels[-1][row, 0]
            row, root = row[root < NONE], root[root < NONE]
            if not len(row):
                break
            i = root & PLACE
            symbols[row, i] = self.merged_ids[root >> 32]
            gone = after[row, i]
            right = np.minimum(after[row, gone], size + 1)  # the last column is never a symbol
            after[row, i] = right
            before[row, right] = i
            symbols[row, gone] = -1
            inside = gone < size
            put(row[inside], gone[inside], NONE)
            value = self._rank_of(symbols[row, i], symbols[row, right])
            inside = i < size
            put(row[inside], i[inside], np.where(value < NONE, value | i, NONE)[inside])
            left = before[row, i]
            inside = left >= 0
            some, left, here = row[inside], left[inside], i[inside]
            value = self._rank_of(symbols[some, left], symbols[some, here])
            put(some, left, np.where(value < NONE, value | left, NONE))
        found = symbols >= 0
        return symbols[found].astype(np.int32), found.sum(1)

    def _forget(self) -> None:
        """Remember the special tokens only."""
        self.known = _Numbers()
        self.flat, self.ends = array("i"), array("q", [0])  # the ids of all pieces remembered, and where each ends
        for content, i in self.special.items():
            self.known[content] = len(self.known)
            self.flat.append(i)
            self.ends.append(len(self.flat))

    def _learn(self) -> None:
        """Have the ids of all pieces met in memory."""
        new, self.known.new = self.known.new, []
        data = [piece.encode("utf-8") for piece in new]
        length = np.fromiter(map(len, data), np.int64, len(data))
        # trees of 1, 2, 4, … leaves for pieces of up to 2, 3, 5, … bytes
        size = np.where(length > SHORT, 0, 1 << np.ceil(np.log2(np.maximum(length - 1, 1))).astype(np.int64))
        order = np.argsort(size, kind="stable")
        ids, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for same in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            for start in range(0, len(same), 20_000):
                some = [data[i] for i in same[start : start + 20_000].tolist()]
                if size[same[0]]:
                    merged, sizes = self._merge_trees(some, int(size[same[0]]))
                else:
                    each = [self.merge(x) for x in some]
                    merged, sizes = np.array([*itertools.chain.from_iterable(each)], np.int32), [*map(len, each)]
                ids.append(merged)
                counts.append(np.asarray(sizes, np.int64))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        merged, until = _gather(np.concatenate(ids), np.cumsum(np.concatenate([[0], *counts])), place)
        self.ends.frombytes((until + len(self.flat)).tobytes())
        self.flat.frombytes(merged.tobytes())

    def _gathered(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and where each piece's end."""
        return _gather(np.frombuffer(self.flat, np.int32), np.frombuffer(self.ends, np.int64), numbers)

    def _parts(self, text: str) -> list[str]:
        return self.cut.split(text) if any(mark in text for mark in self.special) else [text]

    def _pattern_for(self, part: str) -> re.Pattern | regex.Pattern:
        if part.isascii():
            return _plain_pattern(1 << 7)
        return self.pattern if BEYOND.search(part) else _plain_pattern(1 << 16)

    def _numbered(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _encode_long(self, text: str) -> np.ndarray:
        ids = []
        for part in self._parts(text):
            if part in self.special:
                ids.append(np.array([self.special[part]], np.int32))
                continue
            found = (m.group() for m in self._pattern_for(part).finditer(part))
            while pieces := list(itertools.islice(found, 100_000)):
                if len(self.known) > REMEMBERED:
                    self._forget()
                numbers = self._numbered(pieces)
                self._learn()
                ids.append(self._gathered(numbers)[0])
        return np.concatenate([np.empty(0, np.int32), *ids])

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and where each text's begin, with the end of the last."""
        flat, sizes = [], []
        for is_long, some in itertools.groupby(texts, lambda t: len(t) >= LONG_TEXT):
            if is_long:
                for text in some:
                    flat.append(self._encode_long(text))
                    sizes.append([len(flat[-1])])
                continue
            if len(self.known) > REMEMBERED:
                self._forget()
            numbers, counts = [np.empty(0, np.int64)], []
            for text in some:
                pieces: list[str] = []
                for part in self._parts(text):
                    if part in self.special:
                        pieces.append(part)
                    else:
                        pieces += self._pattern_for(part).findall(part)
                numbers.append(self._numbered(pieces))
                counts.append(len(pieces))
            self._learn()
            ids, until = self._gathered(np.concatenate(numbers))
            flat.append(ids)
            sizes.append(np.diff(np.r_[0, until][np.cumsum([0, *counts])]))
        return np.concatenate([np.empty(0, np.int32), *flat]), np.cumsum(np.concatenate([[0], *sizes]), dtype=np.int64)

    def encode(self, texts: list[str]) -> Iterator[Iterable[list[int]]]:
        """Ids of texts, for each in groups."""
        flat, ends = self.encode_flat(texts)
        for a, b in itertools.pairwise(ends.tolist()):
            yield (flat[a:b].tolist(),)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids."""
        ids = list(ids)
        try:
            data = b"".join(map(self.bytes.__getitem__, ids)) if min(ids, default=0) >= 0 else None
        except IndexError:
            data = None
        if data is None:
            data = b"".join(self.bytes[i] for i in ids if 0 <= i < self.width)
        return data.decode("utf-8", "replace")

    def decode_lists(self, lists: pa.Array) -> pa.Array:
        """Texts of lists of ids, null for null."""
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
        ends = np.cumsum(np.r_[0, sizes])
        ids = np.asarray(pc.fill_null(lists.flatten(), -1))
        good = (ids >= 0) & (ids < self.width)
        if not good.all():
            ends, ids = np.cumsum(np.r_[0, good])[ends], ids[good]
        pieces = self.table.take(pa.array(ids))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces), b"")
        try:
            texts = joined.cast(pa.string())  # refuses bytes that are not UTF-8
        except pa.ArrowInvalid:
            texts = pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
        return pc.if_else(lists.is_valid(), texts, None) if lists.null_count else texts


@functools.lru_cache(maxsize=2)
def tokenizer(content: str) -> Tokenizer:
    """One tokenizer per file and Python worker. Its memory holds no cycles, so nothing is gained by
    having the collector walk through it."""
    made = Tokenizer(content)
    gc.collect()
    gc.freeze()
    gc.set_threshold(100_000, 50, 1_000)
    return made


def _file(df: DataFrame, path: str):
    """The vocabulary, read where the job starts and sent to the executors; a file of a few MB."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    tokenizer(content)  # refuses unsupported files before any task starts
    return df.sparkSession.sparkContext.broadcast(content)


def _slices(values: pa.Array, length=pc.binary_length, size: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text, or other units of ``length``, each."""
    start = held = 0
    for i, n in enumerate(length(values).to_pylist()):
        held += n or 0
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(values):
        yield start, len(values)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` with ``ids`` an array of token ids."""
    file = _file(docs, path)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(file.value)
        for batch in batches:
            for start, end in _slices(batch.column(1)):
                part = batch.slice(start, end - start)
                flat, ends = bpe.encode_flat([t or "" for t in part.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "ids"])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, text``; columns named in ``keep`` are carried along."""
    file = _file(tokens, path)
    held = [id_col, *keep]
    rows = tokens.select(*[F.col(c) for c in held], F.col(ids_col).alias("_ids"))
    schema = T.StructType([tokens.schema[c] for c in held] + [T.StructField("text", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(file.value)
        for batch in batches:
            for start, end in _slices(batch.column(len(held)), pc.list_value_length, 1 << 19):
                part = batch.slice(start, end - start)
                columns = [part.column(i) for i in range(len(held))]
                texts = bpe.decode_lists(part.column(len(held)))
                yield pa.RecordBatch.from_arrays([*columns, texts], names=[*held, "text"])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)
