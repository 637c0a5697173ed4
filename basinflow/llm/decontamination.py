"""Benchmark decontamination with an FM-index per shard of the training documents.

A window is ``window`` consecutive terms of an item; an item of fewer, but not none, is one window.
A document's term inside any occurrence of a window is hit.

1. Each task cuts its documents into shards of about ``shard_bytes``, numbers the terms of a shard, sorts all suffixes
   of its texts and writes an FM-index: a wavelet tree of the last column and every ``rate``-th place. The index
   holds all terms of all documents and knows nothing of the items; it can be kept and searched again.
2. Windows of items are dealt into blocks of about ``block_windows``. Every block meets every shard. Backward search
   through the tree's ranks gives each window its range of suffixes; sampled places locate the occurrences.
3. Within a shard occurrences become spans of terms per document; spans of all blocks, and of the pieces of a
   document longer than a shard, are merged per document.

Defined results: null and empty texts have no terms and no hits; null and empty items have no windows. Rows that share
an id are separate documents; rows of items that share an id are one item; a null item id is the empty id. Ids of
documents are integers, null stays null. Further columns are ignored by ``report`` and carried by ``clean``. No items
leave every document clean; no documents give no rows. A document as text must fit in a task; its index is cut into
pieces that overlap by a window less one term.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinflow.llm import fmindex
from basinflow.llm.common import fresh, pieces
from basinflow.llm.terms import (
    TABLE, in_blocks, numbers, packed_words, record_batch, rows_of, terms_of, tokenise, unpacked_words, with_blocks,
)
from basinflow.session import cut, ship_package


@dataclasses.dataclass(frozen=True)
class Settings:
    window: int = 10
    shard_bytes: int = 6_000_000
    rate: int = 16
    block_windows: int = 50_000


INDEX = (
    "shard long, rows array<long>, ids array<long>, texts array<long>, own array<long>, starts binary, offsets binary, "
    "words binary, n int, bits binary, zeros binary, sizes binary, marks binary, samples binary"
)
INDEX_ARROW = pa.schema([
    ("shard", pa.int64()), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())),
    ("texts", pa.list_(pa.int64())), ("own", pa.list_(pa.int64())), ("starts", pa.binary()), ("offsets", pa.binary()),
    ("words", pa.binary()), ("n", pa.int32()), ("bits", pa.binary()), ("zeros", pa.binary()), ("sizes", pa.binary()),
    ("marks", pa.binary()), ("samples", pa.binary()),
])


def _index_of(held: list[tuple[int, int | None, int, int, bytes]], number: int, s: Settings) -> tuple[dict, np.ndarray]:
    """The row of the index for pieces ``(row, id, text's hash, overlap, bytes)``, and the terms of each piece."""
    found = tokenise([x[4] for x in held])
    ends = np.cumsum(found.counts + 1) - 1
    symbols = np.zeros(len(found.codes) + len(held), np.int32)
    places = np.ones(len(symbols), bool)
    places[ends] = False
    symbols[places] = found.codes + 1
    rows, ids, texts, overlaps, _ = zip(*held)
    made = fmindex.build(symbols, s.rate) | {
        "shard": number, "rows": rows, "ids": ids, "texts": texts,
        "own": (found.counts - np.asarray(overlaps)).tolist(),
        "starts": (ends - found.counts).tobytes(), "words": packed_words(found.words),
    }
    return made, found.counts


def _indexes(s: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        row, shard, held, size, gone = base, base, [], 0, {}

        def flush() -> pa.RecordBatch:
            nonlocal shard, held, size
            made, counts = _index_of(held, shard, s)
            offsets = np.zeros(len(held), np.int64)
            for i, (piece, count) in enumerate(zip(held, counts.tolist())):
                offsets[i] = gone.get(piece[0], 0) - piece[3]  # terms of the document in front of this piece
                gone[piece[0]] = offsets[i] + count
            last = held[-1][0]
            for done in [k for k in gone if k != last]:
                del gone[done]
            shard, held, size = shard + 1, [], 0
            return record_batch([made | {"offsets": offsets.tobytes()}], INDEX_ARROW)

        for batch in batches:
            for i in range(batch.num_rows):
                number, digest, text = (batch.column(k)[i] for k in range(3))
                data = (text.as_py() or "").encode("utf-8", "surrogatepass").translate(TABLE)
                tail = b""
                for piece in pieces(data, s.shard_bytes):
                    whole = tail + b" " + piece if tail else piece
                    held.append((row, number.as_py(), digest.as_py(), len(tail.split()), whole))
                    size += len(whole) + 64
                    if len(data) > s.shard_bytes:
                        tail = b" ".join(whole.split()[-(s.window - 1):]) if s.window > 1 else b""
                    if size >= s.shard_bytes:
                        yield flush()
                row += 1
        if held:
            yield flush()

    return run


def index(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the FM-indexes of all documents and return them, one row per shard."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text")
    )
    return cut(rows.mapInArrow(_indexes(settings), INDEX), "fm-index")


def windows(items: DataFrame, settings: Settings = Settings(), id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Blocks of distinct windows and their items: ``block, grams array<string>, items array<string>``."""
    w = settings.window
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), terms_of(text_col).alias("terms"))
    n = F.size("terms")
    starts = F.when(n >= w, F.sequence(F.lit(1), n - (w - 1))).when(n > 0, F.array(F.lit(1))).otherwise(
        F.array().cast("array<int>")
    )
    grams = rows.select("item", "terms", F.explode(starts).alias("at")).select(
        "item", F.array_join(F.slice("terms", F.col("at"), w), " ").alias("gram")
    )
    held = cut(grams.distinct(), "windows")
    return cut(in_blocks(held, settings.block_windows, "gram", "item").groupBy("block").agg(
        F.collect_list("gram").alias("grams"), F.collect_list("item").alias("items")
    ), "window-blocks")


HITS = "row long, spans array<struct<start:long,end:long>>, items array<string>"
HITS_ARROW = pa.schema([
    ("row", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])


def _occurrences(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, lengths and numbers of all windows of a block that occur in a shard."""
    grams = [g.split(" ") for g in row["grams"]]
    flat = numbers([w for g in grams for w in g], unpacked_words(row["words"]))
    symbols = np.where(flat >= 0, flat + 1, -1)
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    begins = np.cumsum(sizes) - sizes
    searcher = fmindex.Index(row)
    places, lengths, found = [], [], []
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        low, high = searcher.search(symbols[begins[mine, None] + np.arange(size)])
        counts = high - low
        total = int(counts.sum())
        rows = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(total)
        places.append(searcher.locate(rows))
        lengths.append(np.full(total, size))
        found.append(np.repeat(mine, counts))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, lengths, found))


def _hits(row: dict) -> list[dict]:
    """Spans and items per document of one shard and block."""
    places, lengths, found = _occurrences(row)
    if not len(places):
        return []
    starts, offsets = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["offsets"], np.int64)
    change = np.zeros(row["n"] + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + lengths, -1)
    inside = np.r_[False, np.cumsum(change) > 0]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    owner = np.searchsorted(starts, begins, "right") - 1
    shift = offsets[owner] - starts[owner]
    names, number = np.unique(np.asarray(row["items"], object), return_inverse=True)
    pairs = np.unique((np.searchsorted(starts, places, "right") - 1) * len(names) + number[found])
    of_doc = np.split(names[pairs % len(names)], np.flatnonzero(np.diff(pairs // len(names))) + 1)
    docs = np.unique(pairs // len(names))
    cuts = np.searchsorted(owner, docs)
    spans = np.stack([begins + shift, ends + shift], 1).tolist()
    return [
        {"row": row["rows"][doc], "items": held.tolist(),
         "spans": [{"start": a, "end": b} for a, b in spans[cuts[i] : cuts[i + 1] if i + 1 < len(docs) else len(spans)]]}
        for i, (doc, held) in enumerate(zip(docs.tolist(), of_doc))
    ]


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        found = _hits(row)
        for i in range(0, len(found), 5_000):
            yield record_batch(found[i : i + 5_000], HITS_ARROW)


def _merged(spans):
    """Spans in order, overlapping and touching ones joined."""

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))),
        )
        return F.when((F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"]), joined).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(spans, F.array().cast("array<struct<start:long,end:long>>"), add)


def report(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: ``id, digest, n_words, spans, n_hit, items``.

    ``spans`` are the merged ranges of hit terms, from 0, without the end; ``items`` are the ids of items with occurring
    windows, in order; ``digest`` is Spark's hash of the text.
    """
    held = index(docs, settings, id_col, text_col)
    blocks = windows(items, settings, item_id, item_text)
    wanted = ["rows", "starts", "offsets", "words", "n", "bits", "zeros", "sizes", "marks", "samples"]
    met = with_blocks(held.select("shard", *wanted), blocks).select(*wanted, "grams", "items")
    hits = met.mapInArrow(_search, HITS)
    parts = held.select(F.explode(F.arrays_zip("rows", "ids", "texts", "own")).alias("d")).select(
        F.col("d.rows").alias("row"), F.col("d.ids").alias("id"), F.col("d.texts").alias("digest"),
        F.col("d.own").alias("own"), F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    none = F.lit(None).cast("long")
    rows = parts.unionByName(hits.select(
        "row", none.alias("id"), none.alias("digest"), F.lit(0).cast("long").alias("own"), "spans", "items"
    ))
    whole = rows.groupBy("row").agg(
        F.max("id").alias("id"), F.max("digest").alias("digest"), F.sum("own").alias("n_words"),
        _merged(F.array_sort(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return whole.select("id", "digest", "n_words", "spans", n_hit.alias("n_hit"), "items")


def _without(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes from the first to the last term of each span."""
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if spans:
                data = text.encode()
                term = np.frombuffer(data.translate(TABLE), np.uint8) != 32
                edges = np.flatnonzero(np.diff(np.r_[False, term, False]))
                begins, ends = edges[::2], edges[1::2]
                keep = np.ones(len(data), bool)
                for span in spans:
                    keep[begins[span["start"]] : ends[span["end"] - 1]] = False
                text = np.frombuffer(data, np.uint8)[keep].tobytes().decode()
            texts.append(text)
        columns = [pa.array(texts, pa.string())] + [batch.column(i) for i in range(2, batch.num_columns)]
        yield pa.RecordBatch.from_arrays(columns, names=["text", *batch.schema.names[2:]])


def clean(
    docs: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The documents with all their columns, the hit spans cut out of their texts."""
    hit, number, digest = (fresh(docs, x) for x in ("spans", "number", "digest"))
    found = report(docs, items, settings, id_col, text_col, item_id, item_text).filter("n_hit > 0").select(
        F.col("id").alias(number), F.col("digest").alias(digest), F.col("spans").alias(hit)
    ).dropDuplicates([number, digest])  # rows equal in id and text have equal spans
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    text, own = names[text_col], F.col(names[id_col]).cast("long")
    marked = plain.join(found, own.eqNullSafe(F.col(number)) & (F.xxhash64(text) == F.col(digest)), "left").select(
        F.col(text), F.col(hit), *[F.col(c) for c in plain.columns if c != text]
    )
    rest = [f for f in plain.schema.fields if f.name != text]
    schema = "text string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest)
    done = marked.mapInArrow(_without, schema.rstrip(", "))
    return done.select(*[F.col("text" if c == text_col else names[c]).alias(c) for c in docs.columns])
