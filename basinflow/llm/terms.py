"""Terms of texts as numbers, and queries in blocks: what the index operators share.

A term is a run of ASCII letters and digits, A-Z lower-cased, and of characters outside ASCII.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # in texts whose A-Z are lower-cased

_KEPT = LOWER.encode() + b"0123456789" + bytes(range(128, 256))
# What becomes of each byte of a text in UTF-8: part of a term, or a space.
TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode()).translate(
    bytes(b if b in _KEPT else 32 for b in range(256))
)


def terms_of(text: Column | str) -> Column:
    """The terms of a text in order; null has none."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


@dataclasses.dataclass
class Terms:
    """Terms of several texts: ``codes`` number the ``words`` of this object, ``counts`` are terms per text."""

    codes: np.ndarray
    counts: np.ndarray
    words: pa.Array


def tokenise(texts: list[bytes]) -> Terms:
    """Terms of texts that went through ``TABLE``."""
    ends = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=ends[1:])
    column = pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(b"".join(texts)))
    parts = pc.ascii_split_whitespace(column)
    flat = parts.flatten().dictionary_encode()
    codes = flat.indices.to_numpy()
    sizes = np.diff(parts.offsets.to_numpy())
    blank = pc.index(flat.dictionary, "").as_py()  # what splitting leaves at the ends of texts
    full = codes != blank
    counts = np.bincount(np.repeat(np.arange(len(texts)), sizes)[full], minlength=len(texts))
    return Terms(codes[full], counts.astype(np.int64), flat.dictionary)


def packed_words(words: pa.Array) -> bytes:
    """Words in one value; terms hold no line feed."""
    one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(one, "\n")[0].as_py().encode()


def unpacked_words(data: bytes) -> pa.Array:
    return pc.split_pattern(pa.array([data.decode()], pa.string()), "\n").flatten()


def numbers(wanted: list[str], words: pa.Array) -> np.ndarray:
    """Where each wanted word stands among ``words``, -1 where it does not."""
    return pc.fill_null(pc.index_in(pa.array(wanted, pa.string()), value_set=words), -1).to_numpy().astype(np.int64)


def record_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema
    )


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that one large value of a column is held as Python object, not all."""
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(names)}


def with_blocks(index: DataFrame, blocks: DataFrame, most: int = 8_000_000, salts: int = 64) -> DataFrame:
    """Every row of ``index`` (with a long ``shard``) next to every row of ``blocks`` (with ``block`` from 0).

    Blocks of a stated query set meet all shards. They are broadcast if measured to hold ``most`` bytes or fewer.
    Beyond that each block is repeated once per salt and shards are dealt over the salts, so that no block draws all
    shards to one task.
    """
    n, size = blocks.agg(
        F.coalesce(F.max("block") + 1, F.lit(0)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    ).first()
    each = F.explode(F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>"))
    dealt = index.withColumn("block", each)
    if size <= most:
        return dealt.join(F.broadcast(blocks), "block")
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(salts)).cast("int"))
    copies = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies.hint("merge"), ["block", "salt"])


def in_blocks(entries: DataFrame, size: int, *key: str) -> DataFrame:
    """``entries`` with ``block``, dealt by a hash of ``key`` into as many blocks as hold about ``size`` each."""
    n = -(-entries.count() // size)
    return entries.withColumn("block", F.pmod(F.xxhash64(*key), F.lit(max(1, n))).cast("int"))
