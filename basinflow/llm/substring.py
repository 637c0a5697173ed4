"""Substring dedup with suffixes in groups, partitioned by prefixes of varying length.

A window is ``window`` consecutive words of one document. Words covered by a window that also starts in
a document with a smaller id are removed; windows are judged on the input, not on what is left.

1. Texts with equal words are taken once, with their least id; larger ids lose all their windows.
2. Suffixes without a partner would be single leaves of a suffix tree. To leave them out early, each window
   names an anchor, the run of ``anchor`` words in it with the least hash; equal windows name equal
   anchors. Only suffixes near an anchor that occurs in two texts go on. Anchors are gathered by hash in
   parts of bounded size; a task sends an anchor once, however often it met it.
3. The suffixes left, cut to ``window`` words, are dealt into groups by prefix. Prefixes are as long as it takes
   to make groups that fit in memory: a prefix too frequent in a bounded sample of documents is
   extended by a word; one that stays too frequent is divided by a hash of the whole suffix. The
   sample only decides how even the groups are.
4. Within a task, equal suffixes are combined first: all but the least id are covered there and then, so
   a passage that a third of all documents share reaches its group as one leaf per task.
5. Each group is sorted; a run of equal neighbours is a node of the suffix tree at the depth of ``window``
   words. Only this level is made: common-prefix lengths, other inner nodes and maximal repeats are not, as
   they would cover the same windows. Leaves with an id above the node's least id are covered.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing. Ids are
integers; a null id counts as larger than all others, and rows that share an id are not smaller than
each other. Repeated rows get equal results. Further columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import dataclasses
import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinflow.llm.common import word_count, word_line
from basinflow.llm.minhash import MIX
from basinflow.session import ship_package

NO_ID = 2**63 - 1
PLACE = 2**32 - 1


@dataclasses.dataclass(frozen=True)
class Settings:
    """``part_words`` and ``group_words`` are the words of input per part of anchors and per group of
    suffixes; ``sample_docs`` and ``sample_chars`` bound the sample that prefixes are chosen by."""

    window: int = 13
    anchor: int = 8
    part_words: int = 4_000_000
    group_words: int = 400_000
    task_anchors: int = 1_000_000
    task_suffixes: int = 400_000
    sample_docs: int = 1_000
    sample_chars: int = 10_000


def _numbers(n: int, start: int) -> np.ndarray:
    """Fixed numbers without visible order."""
    x = np.arange(start, start + n, dtype=np.uint64) * MIX
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


LETTER, STEP = _numbers(256, 1), _numbers(1 << 10, 1_000)
SPAN = 1 << 20  # bytes of text whose words are hashed at once
LETTER[32] = 0  # a space adds nothing to the word in front of it


def _word_hashes(line: bytes) -> np.ndarray:
    """A hash of each word of a line, from its bytes and their places in it; no word is looked up."""
    letters = np.frombuffer(line, np.uint8)
    starts = np.r_[0, np.flatnonzero(letters == 32) + 1, len(letters)]
    cuts = [0, len(starts) - 1]
    if len(letters) > SPAN:  # of a very long text, some words at a time
        cuts = np.unique(np.r_[cuts, np.searchsorted(starts, np.arange(SPAN, len(letters), SPAN))]).tolist()
    found = []
    for a, b in itertools.pairwise(cuts):
        here = starts[a : b + 1] - starts[a]
        place = np.arange(here[-1]) - np.repeat(here[:-1], np.diff(here))
        values = LETTER[letters[starts[a] : starts[b]]] * STEP[place & (len(STEP) - 1)]
        found.append(np.add.reduceat(values, here[:-1]))
    return np.concatenate(found)


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words."""
    total = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        total = (total + words[i : len(total) + i]) * MIX
        total ^= total >> np.uint64(31)
    return total


def anchors(line: bytes, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors that the windows of a text name."""
    runs = _rolled(_word_hashes(line), s.anchor)
    views = np.lib.stride_tricks.sliding_window_view(runs, s.window - s.anchor + 1)
    places = views.argmin(1) + np.arange(len(views))  # never falls
    places = places[np.r_[True, places[1:] != places[:-1]]]
    return places, runs[places]


class Prefixes:
    """A trie of words; every suffix falls to the shortest prefix that is not divided further, and many
    small prefixes share a group."""

    def __init__(self, suffixes: list[list[bytes]], groups: int):
        self.groups = groups
        self.divided: dict[tuple[bytes, ...], int] = {}
        most = max(1.0, len(suffixes) / max(1, groups))
        todo = [((), suffixes)]
        while todo:
            prefix, held = todo.pop()
            deeper = defaultdict(list)
            for words in held:
                if len(words) > len(prefix):
                    deeper[words[len(prefix)]].append(words)
            whole = sum(map(len, deeper.values()))
            if len(deeper) < 2 or whole <= 2 * most:  # one way only, or small: divide by hash if need be
                self.divided[prefix] = -max(1, round(len(held) / most))
                continue
            self.divided[prefix] = 1
            todo += [(prefix + (w,), d) for w, d in deeper.items() if len(d) > 2 * most]
        self.depth = 1 + max(map(len, self.divided))

    def group(self, content: bytes) -> int:
        """A number for the group of a suffix, the same for equal suffixes in every task."""
        prefix = ()
        for word in content.split(b" ", self.depth)[: self.depth]:
            if self.divided.get(prefix, 0) < 1:
                break
            prefix += (word,)
        parts = -self.divided.get(prefix, -1)
        number = xxhash.xxh3_64_intdigest(b" ".join(prefix))
        if parts > 1:
            number += 1 + xxhash.xxh3_64_intdigest(content) % parts
        return number % self.groups


def _sample(docs: DataFrame, s: Settings, n_docs: int, id_col: str, text_col: str) -> list[list[bytes]]:
    """Every fourth suffix of a bounded sample of documents, chosen by a hash of their ids."""
    every = max(1, n_docs // max(1, s.sample_docs))
    rows = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(every)) == 0).limit(2 * s.sample_docs)
    found = []
    for (line,) in rows.select(word_line(F.substring(text_col, 1, s.sample_chars))).collect():
        words = line.encode("utf-8").split(b" ")
        found += [words[i : i + s.window] for i in range(0, len(words) - s.window + 1, 4)]
    return found


def _pack(values: np.ndarray | list, kind: type) -> bytes:
    return np.asarray(values, kind).tobytes()


def _by_document(keys: list[bytes], docs: np.ndarray, places: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """``key, packed places`` per document; ``docs`` must be in order."""
    if not len(docs):
        return
    cuts = np.flatnonzero(np.diff(docs)) + 1
    for doc, found in zip(docs[np.r_[0, cuts]].tolist(), np.split(places, cuts)):
        yield keys[doc], _pack(found, np.int32)


PARTED = "part int, known binary, keys binary, counts binary, places binary, marks binary, key binary"


def _send_anchors(s: Settings, parts: int):
    """Task side of step 2: anchors for each part, and documents' places already known to repeat."""

    def flush(keys: list[bytes], docs: np.ndarray, places: np.ndarray, marks: np.ndarray) -> Iterator[dict]:
        order = np.argsort(marks, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(marks[order]) != 0])
        sizes = np.diff(np.r_[starts, len(order)])
        repeated = docs[order][starts] != docs[order][starts + sizes - 1]
        shared = np.empty(len(order), bool)
        shared[order] = np.repeat(repeated, sizes)
        for key, found in _by_document(keys, docs[shared], places[shared]):
            yield {"part": int.from_bytes(key[:6], "big") % parts, "key": key, "places": found}
        known = marks[order][starts[repeated]]
        known_part, part = (known >> np.uint64(32)) % np.uint64(parts), (marks >> np.uint64(32)) % np.uint64(parts)
        known_order = np.argsort(known_part, kind="stable")
        ask = np.flatnonzero(~shared)
        ask = ask[np.argsort(part[ask], kind="stable")]
        bounds = np.arange(parts + 1)
        ask_at = np.searchsorted(part[ask], bounds)
        known_at = np.searchsorted(known_part[known_order], bounds)
        for p in range(parts):
            mine, told = ask[ask_at[p] : ask_at[p + 1]], known_order[known_at[p] : known_at[p + 1]]
            if not len(mine) and not len(told):
                continue
            owner, counts = np.unique(docs[mine], return_counts=True)
            yield {
                "part": p, "known": _pack(known[told] & np.uint64(2**32 - 1), np.uint32),
                "keys": b"".join(keys[i] for i in owner), "counts": _pack(counts, np.int32),
                "places": _pack(places[mine], np.int32), "marks": _pack(marks[mine] & np.uint64(2**32 - 1), np.uint32),
            }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, places, marks, held = [], [], [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            rows: list[dict] = []
            for row in flush(keys, np.concatenate(docs), np.concatenate(places), np.concatenate(marks)):
                rows.append(row)
                if len(rows) >= 2_000:
                    yield _batch(rows, PARTED)
                    rows = []
            if rows:
                yield _batch(rows, PARTED)

        for batch in batches:
            for key, line in zip(batch.column("key").to_pylist(), batch.column("line")):
                at, found = anchors(line.as_py().encode("utf-8"), s)
                docs.append(np.full(len(at), len(keys)))
                keys.append(key)
                places.append(at)
                marks.append(found)
                held += len(at)
                if held >= s.task_anchors:
                    yield from out()
                    keys, docs, places, marks, held = [], [], [], [], 0
        if held:
            yield from out()

    return run


KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = [pa.array([r.get(name) for r in rows], KINDS[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), kind)


PLACED = "part int, keys binary, counts binary, places binary"
KEYED = "key binary, places binary"


def _dealt(found: Iterable[tuple[bytes, bytes]], parts: int) -> pa.Table:
    """Documents' places on their way back, one row per part of documents."""
    held = defaultdict(list)
    for key, places in found:
        held[int.from_bytes(key[:6], "big") % parts].append((key, places))
    rows = [
        {"part": part, "keys": b"".join(k for k, _ in some), "places": b"".join(p for _, p in some),
         "counts": _pack([len(p) // 4 for _, p in some], np.int32)}
        for part, some in held.items()
    ]
    return pa.Table.from_batches([_batch(rows, PLACED)])


def _by_key(table: pa.Table) -> pa.Table:
    """``key, places`` of the documents of a part, one row each."""
    found = defaultdict(list)
    for row in table.to_pylist():
        at = 0
        for i, count in enumerate(np.frombuffer(row["counts"], np.int32).tolist()):
            found[row["keys"][16 * i : 16 * i + 16]].append(row["places"][at : at + 4 * count])
            at += 4 * count
    rows = [{"key": k, "places": b"".join(p)} for k, p in found.items()]
    return pa.Table.from_batches([_batch(rows, KEYED)])


def _passed_on(table: pa.Table) -> Iterator[tuple[bytes, bytes]]:
    """The rows that were settled before they got here."""
    done = table.filter(pc.is_valid(table.column("key")))
    return zip(done.column("key").to_pylist(), done.column("places").to_pylist())


def _repeated_anchors(table: pa.Table, parts: int) -> pa.Table:
    """Part side of step 2: places of anchors that occur in two texts."""
    asked = table.filter(pc.is_null(table.column("key")))
    known, marks = _joined(asked, "known", np.uint32), _joined(asked, "marks", np.uint32)
    packed = b"".join(asked.column("keys").to_pylist())
    keys = [packed[i : i + 16] for i in range(0, len(packed), 16)]
    docs = np.repeat(np.arange(len(keys)), _joined(asked, "counts", np.int32))
    places = _joined(asked, "places", np.int32)
    order = np.argsort(marks, kind="stable")
    if len(order):
        starts = np.flatnonzero(np.r_[True, np.diff(marks[order]) != 0])
        sizes = np.diff(np.r_[starts, len(order)])
        repeated = np.minimum.reduceat(docs[order], starts) != np.maximum.reduceat(docs[order], starts)
        repeated |= np.isin(marks[order][starts], known)
        good = np.empty(len(order), bool)
        good[order] = np.repeat(repeated, sizes)
        docs, places = docs[good], places[good]
    return _dealt(itertools.chain(_passed_on(table), _by_document(keys, docs, places)), parts)


GROUPED = "group long, contents binary, owner binary, keys binary, ids binary, places binary, key binary"


def _send_suffixes(s: Settings, prefixes: Prefixes):
    """Task side of steps 3 and 4."""
    reach = s.window - s.anchor

    def flush(found: dict[bytes, list[int]], keys: list[bytes], ids: list[int]) -> Iterator[dict]:
        covered = defaultdict(list)
        grouped = defaultdict(list)
        for content, held in found.items():
            mine = grouped[prefixes.group(content)]
            if len(held) == 1:
                mine.append((content, held[0]))
                continue
            least = min(ids[spot >> 32] for spot in held)
            for spot in held:
                if ids[spot >> 32] > least:
                    covered[spot >> 32].append(spot & PLACE)
                else:
                    mine.append((content, spot))
        packer = zstandard.ZstdCompressor(level=3)
        for group, rows in grouped.items():
            rows.sort()
            spots = np.fromiter((spot for _, spot in rows), np.int64, len(rows))
            docs, owner = np.unique(spots >> 32, return_inverse=True)
            yield {
                "group": group,
                "contents": packer.compress(b"\n".join([c for c, _ in rows])),
                "owner": _pack(owner, np.int32),
                "keys": b"".join([keys[d] for d in docs]), "ids": _pack([ids[d] for d in docs], np.int64),
                "places": _pack(spots & PLACE, np.int32),
            }
        for doc, places in covered.items():
            yield {"group": int.from_bytes(keys[doc][:6], "big") % prefixes.groups, "key": keys[doc],
                   "places": _pack(places, np.int32)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, keys, ids, held = defaultdict(list), [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            rows: list[dict] = []
            for row in flush(found, keys, ids):
                rows.append(row)
                if len(rows) >= 2_000:
                    yield _batch(rows, GROUPED)
                    rows = []
            if rows:
                yield _batch(rows, GROUPED)

        for batch in batches:
            columns = (batch.column(c) for c in ("key", "id", "line", "places"))
            for key, number, line, places in zip(*columns):
                data = line.as_py().encode("utf-8")
                starts = np.r_[0, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1, len(data) + 1]
                last = len(starts) - 1 - s.window
                near = np.zeros(last + 2, np.int32)
                at = np.frombuffer(places.as_py(), np.int32)
                np.add.at(near, np.clip(at - reach, 0, last + 1), 1)
                np.add.at(near, np.clip(at + 1, 0, last + 1), -1)
                windows = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                ends = (starts[windows + s.window] - 1).tolist()
                spots = ((len(keys) << 32) + windows).tolist()  # document and place in one number
                for spot, a, b in zip(spots, starts[windows].tolist(), ends):
                    found[data[a:b]].append(spot)
                keys.append(key.as_py())
                ids.append(NO_ID if not number.is_valid else number.as_py())
                held += len(windows)
                if held >= s.task_suffixes:
                    yield from out()
                    found, keys, ids, held = defaultdict(list), [], [], 0
        if held:
            yield from out()

    return run


def deep_nodes(suffixes: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of leaves below the topmost inner nodes as deep as the suffixes were cut.

    ``suffixes`` are sorted and cut to the same number of words, so neighbours have a common prefix of that
    depth if they are equal; a node is a run of such neighbours.
    """
    start = 0
    for i in range(1, len(suffixes) + 1):
        if i < len(suffixes) and suffixes[i - 1] == suffixes[i]:
            continue
        if i - start > 1:
            yield start, i
        start = i


def _covered_windows(table: pa.Table, parts: int) -> pa.Table:
    """Group side: places of the covered windows."""
    told = table.filter(pc.is_null(table.column("key")))
    unpack = zstandard.ZstdDecompressor()
    leaves: list[tuple[bytes, int, int]] = []
    keys: list[bytes] = []
    numbers: list[int] = []
    for row in told.to_pylist():
        contents = unpack.decompress(row["contents"]).split(b"\n")
        owner = np.frombuffer(row["owner"], np.int32) + len(keys)
        leaves += zip(contents, owner.tolist(), np.frombuffer(row["places"], np.int32).tolist())
        keys += [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]
        numbers += np.frombuffer(row["ids"], np.int64).tolist()
    leaves.sort()
    covered = defaultdict(list)
    for start, end in deep_nodes([x for x, _, _ in leaves]):
        least = min(numbers[doc] for _, doc, _ in leaves[start:end])
        for _, doc, place in leaves[start:end]:
            if numbers[doc] > least:
                covered[doc].append(place)
    here = ((keys[d], _pack(p, np.int32)) for d, p in covered.items())
    return _dealt(itertools.chain(_passed_on(table), here), parts)


def _key(line) -> object:
    return F.unhex(F.substring(F.sha2(line, 256), 1, 32))


def texts(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """``key, id, line`` of each distinct text that has a window."""
    rows = docs.filter(word_count(text_col) >= s.window).select(
        F.col(id_col).cast("long").alias("id"), word_line(text_col).alias("line")
    )
    # The filter is what an inner join on the key would add: with it, all uses of this table share one shuffle.
    keyed = rows.select(_key(F.col("line")).alias("key"), "id", "line").filter("key IS NOT NULL")
    return keyed.groupBy("key").agg(
        F.min("id").alias("id"), F.min("line").alias("line")
    )


def covered(held: DataFrame, s: Settings, words: int, sample: list[list[bytes]]) -> DataFrame:
    """``key, places``: where covered windows start in ``held (key, id, line)``, which has about ``words``
    words; prefixes are chosen by the suffixes in ``sample``."""
    parts = max(16, words // s.part_words)
    prefixes = Prefixes(sample, max(64, words // s.group_words))
    sent = held.select("key", "id", "line").mapInArrow(_send_anchors(s, parts), PARTED)
    near = sent.groupBy("part").applyInArrow(lambda t: _repeated_anchors(t, parts), PLACED)
    near = near.groupBy("part").applyInArrow(_by_key, KEYED)
    suffixes = held.join(near, "key").select("key", "id", "line", "places")
    grouped = suffixes.mapInArrow(_send_suffixes(s, prefixes), GROUPED)
    found = grouped.groupBy("group").applyInArrow(lambda t: _covered_windows(t, parts), PLACED)
    return found.groupBy("part").applyInArrow(_by_key, KEYED)


def _without(window: int):
    """What is left of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, number, line, places in zip(*(batch.column(c) for c in ("key", "id", "line", "places"))):
                row = {"key": key.as_py(), "least": number.as_py(), "gone": 0}
                if places.is_valid:
                    words = line.as_py().split(" ")
                    change = np.zeros(len(words) + 1, np.int32)
                    at = np.unique(np.frombuffer(places.as_py(), np.int32))
                    change[at] += 1
                    change[at + window] -= 1
                    out = np.cumsum(change[:-1]) > 0
                    row |= {"gone": int(out.sum()), "left": " ".join(w for w, x in zip(words, out) if not x)}
                rows.append(row)
            yield _batch(rows, "key binary, least long, gone long, left string")

    return run


def left_of_texts(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``key, least, gone, left`` of each distinct text that has a window: its least id, how many words
    a document with that id loses, and what is left (null where nothing is lost)."""
    s = settings
    ship_package(docs.sparkSession)
    words, n_docs = docs.agg(F.coalesce(F.sum(word_count(text_col)), F.lit(0)), F.count("*")).first()
    sample = _sample(docs, s, n_docs, id_col, text_col)
    held = texts(docs, s, id_col, text_col)
    marked = held.join(covered(held, s, words, sample), "key", "left").select("key", "id", "line", "places")
    return marked.mapInArrow(_without(s.window), "key binary, least long, gone long, left string")


def per_document(
    docs: DataFrame, left: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
    text_col: str = "text", carry: tuple[str, ...] = ("left",),
) -> DataFrame:
    """One row per document: id, ``n_words, n_removed, digest`` of its words, and columns of ``left``.

    The columns named in ``carry`` are null unless the document loses some words but not all.
    """
    line = word_line(text_col)
    rows = docs.select(
        F.col(id_col), _key(line).alias("key"), word_count(text_col).alias("n_words"),
        F.sha2(line, 256).alias("digest"),
    )
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) <= F.coalesce("least", F.lit(NO_ID))
    some = own & (F.col("gone") > 0)
    joined = rows.join(left, "key", "left")
    return joined.select(
        id_col, "n_words",
        F.when(F.col("gone").isNull(), F.lit(0)).when(own, F.col("gone")).otherwise(F.col("n_words"))
        .cast("long").alias("n_removed"),
        "digest", *[F.when(some, F.col(c)).alias(c) for c in carry],
    )


def dedup(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, text`` per document, the text being the words that are left, joined by spaces."""
    s = settings
    left = left_of_texts(docs, s, id_col, text_col)
    line = word_line(text_col)
    rows = docs.select(F.col(id_col), line.alias("line"), _key(line).alias("key"))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) <= F.coalesce("least", F.lit(NO_ID))
    text = F.when(F.col("gone").isNull(), F.col("line")).when(~own, F.lit("")).otherwise(
        F.coalesce("left", "line")
    )
    return rows.join(left, "key", "left").select(id_col, text.alias("text"))
