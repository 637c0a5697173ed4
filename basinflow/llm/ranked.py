"""Ranked lexical search by Block-Max MaxScore over inverted indexes per shard.

1. Each task cuts its documents into shards of about ``shard_bytes`` and writes an inverted index of all their terms: posting
   lists in compressed blocks with impacts (``postings``).
2. Numbers of documents holding the queries' terms are summed over the shards, and weights made of them.
3. Queries, in blocks of about ``block_terms`` terms, meet every shard. Lists are taken in order of their bounds. As long as
   what is left could reach the threshold alone, a list is essential: it is read whole and yields candidates.
   On the other lists block maxima, found by the blocks' borders, reject candidates before a block is unpacked; only
   blocks that a surviving candidate falls into are. The threshold is the score of the last of the best ``k`` so far, of
   this task's earlier shards or of partial sums in this one.
4. Tasks keep one heap per query over all their shards; heaps are merged by Spark.

The score of a document is the sum over the query's distinct terms of ``w * ((10^9 * tf) div (1000 * tf + 20 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 50 + (50 * n * N) div L``: N documents with terms, L terms in them, n terms
in the document. All but ``w`` is 64-bit integer. Nothing is approximated: pruning drops only what cannot be among the best.

Defined results: null and empty texts have no terms and are found by no query; queries without terms return no rows. Rows of
queries that share an id are one query; a null id is one more. Rows of documents that share an id are ranked one by one.
Equal scores stand by ascending id, null last. Ids are integers. Further columns are ignored. No documents or no queries
give no rows. One query and one document must fit in a task.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basinflow.llm import postings
from basinflow.llm.common import pieces
from basinflow.llm.terms import (
    TABLE, in_blocks, numbers, packed_words, record_batch, rows_of, terms_of, tokenise, unpacked_words, with_blocks,
)
from basinflow.session import cut, ship_package

NO_ID = 2**63 - 1


@dataclasses.dataclass(frozen=True)
class Settings:
    k: int = 50
    shard_bytes: int = 6_000_000
    block_terms: int = 50_000
    task_queries: int = 20_000  # heaps that a task holds at once


INDEX = "shard long, n_docs long, n_terms long, ids array<long>, lengths binary, words binary, " + ", ".join(
    f"{x} binary" for x in postings.NAMES
)
INDEX_ARROW = pa.schema([
    ("shard", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())),
    ("lengths", pa.binary()), ("words", pa.binary()), *((x, pa.binary()) for x in postings.NAMES),
])


def _counted(held: list[tuple[int, bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """``words, terms, docs, counts`` of texts ``(document, bytes)``, in order of terms and documents."""
    found = tokenise([x for _, x in held])
    docs = np.repeat(np.fromiter((d for d, _ in held), np.int64, len(held)), found.counts)
    width = int(docs.max(initial=0)) + 1
    pairs, counts = np.unique(found.codes.astype(np.int64) * width + docs, return_counts=True)
    return found.words, pairs // width, pairs % width, counts


def _joined(parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]):
    """Several such counts as one."""
    if len(parts) == 1:
        return parts[0]
    words = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    codes, at = words.indices.to_numpy().astype(np.int64), np.cumsum([0] + [len(p[0]) for p in parts])
    terms = np.concatenate([codes[a : a + len(p[0])][p[1]] for a, p in zip(at, parts)])
    docs = np.concatenate([p[2] for p in parts])
    width = int(docs.max(initial=0)) + 1
    pairs, where = np.unique(terms * width + docs, return_inverse=True)
    counts = np.bincount(where, np.concatenate([p[3] for p in parts]), len(pairs)).astype(np.int64)
    return words.dictionary, pairs // width, pairs % width, counts


def _indexes(s: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 40
        ids: list[int | None] = []
        parts, held, size, whole = [], [], 0, 0

        def count() -> None:
            nonlocal held, size
            if held:
                parts.append(_counted(held))
                held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, ids, parts, whole
            count()
            words, terms, docs, tfs = _joined(parts)
            lengths = np.bincount(docs, tfs, len(ids)).astype(np.int64)
            made = postings.build(terms, docs, tfs, lengths, len(words)) | {
                "shard": shard, "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()), "ids": ids,
                "lengths": lengths.tobytes(), "words": packed_words(words),
            }
            shard, ids, parts, whole = shard + 1, [], [], 0
            return record_batch([made], INDEX_ARROW)

        for batch in batches:
            for i in range(batch.num_rows):
                data = (batch.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass").translate(TABLE)
                for piece in pieces(data, s.shard_bytes):
                    held.append((len(ids), piece))
                    size += len(piece)
                    if size >= s.shard_bytes:  # also within a long document: only its counts are kept
                        count()
                ids.append(batch.column(0)[i].as_py())
                whole += len(data) + 64
                if whole >= s.shard_bytes:
                    yield flush()
        if ids:
            yield flush()

    return run


def index(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the inverted indexes of all documents and return them, one row per shard."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return cut(rows.mapInArrow(_indexes(settings), INDEX), "inverted-index")


DF_ARROW = pa.schema([("term", pa.string()), ("df", pa.int64())])


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        at = numbers(row["terms"], unpacked_words(row["words"]))
        df = np.frombuffer(row["df"], np.int32)
        found = np.flatnonzero(at >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["terms"][i] for i in found], pa.string()), pa.array(df[at[found]].astype(np.int64))],
            schema=DF_ARROW,
        )


def weighted(held: DataFrame, queries: DataFrame, s: Settings, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """Blocks of queries, ``block, queries array<struct<id, terms, weights>>``, and the corpus's N and L."""
    n, total = held.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    wanted = cut(queries.select(
        F.col(id_col).cast("long").alias("id"), F.explode(F.array_distinct(terms_of(text_col))).alias("term")
    ).distinct(), "query-terms")
    terms = cut(in_blocks(wanted.select("term").distinct(), s.block_terms, "term").groupBy("block").agg(
        F.collect_list("term").alias("terms")
    ), "term-blocks")
    met = with_blocks(held.select("shard", "words", "df"), terms).select("terms", "words", "df")
    df = met.mapInArrow(_frequencies, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    whole = in_blocks(wanted, s.block_terms, "id").join(df, "term").groupBy("block", "id").agg(
        F.collect_list("term").alias("terms"), F.collect_list(weight).alias("weights")
    )
    return cut(whole.groupBy("block").agg(
        F.collect_list(F.struct("id", "terms", "weights")).alias("queries")
    ), "queries"), n, total


class Heap:
    """The best ``k`` of one query so far, as arrays in order."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.zeros((2, 0), np.int64)

    @property
    def threshold(self) -> int:
        """A document needs at least this; one that equals it may have the smaller id."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]


def search(lists: postings.Lists, terms: np.ndarray, weights: np.ndarray, k: int, threshold: int):
    """Documents of a shard that may be among the best, with their whole scores.

    ``threshold`` (1 at least) is a score below which no document counts. ``terms`` are numbers of lists.
    """
    ranges = [lists.blocks(t) for t in terms.tolist()]
    bounds = [lists.bounds(np.arange(a, b)) * w for (a, b), w in zip(ranges, weights.tolist())]
    tops = np.array([b.max(initial=0) for b in bounds], np.int64)
    order = np.argsort(-tops, kind="stable")
    left = np.r_[np.cumsum(tops[order][::-1])[::-1], 0]
    sums = np.zeros(len(lists.lengths), np.int64)
    done = 0
    while done < len(order) and left[done] >= threshold:  # essential: what is left could suffice by itself
        t = order[done]
        docs, parts = lists.some(range(*ranges[t]))
        sums[docs] += parts * weights[t]
        done += 1
        if len(sums) > k and left[done] >= threshold:
            threshold = max(threshold, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    if len(sums) > k:
        threshold = max(threshold, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
    found = np.flatnonzero((sums > 0) & (sums + left[done] >= threshold))
    scores = sums[found]
    rest = order[done:]
    at = np.full((len(rest), len(found)), -1, np.int64)
    most = np.zeros((len(rest), len(found)), np.int64)
    for i, t in enumerate(rest):  # the block of each list that a candidate would be in, by the blocks' borders
        a, b = ranges[t]
        where = np.searchsorted(lists.lasts[a:b], found)
        inside = where < b - a
        inside[inside] = lists.firsts[a:b][where[inside]] <= found[inside]
        at[i, inside] = a + where[inside]
        most[i, inside] = bounds[t][where[inside]]
    hope = scores + most.sum(0)
    alive = np.flatnonzero(hope >= threshold)
    for i, t in enumerate(rest):
        mine = alive[at[i, alive] >= 0]
        if len(mine):
            docs, parts = lists.some(np.unique(at[i, mine]))
            where = np.minimum(np.searchsorted(docs, found[mine]), len(docs) - 1)
            gain = np.where(docs[where] == found[mine], parts[where] * weights[t], 0)
            scores[mine] += gain
            hope[mine] += gain - most[i, mine]
            alive = alive[hope[alive] >= threshold]
    return found[alive], scores[alive]


BEST_ARROW = pa.schema([("item", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])


def _search(s: Settings, n: int, total: int):
    def part(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * length * n // total))

    def out(heaps: dict[int | None, Heap]) -> Iterator[pa.RecordBatch]:
        for item, heap in heaps.items():
            ids = pa.array(heap.ids, mask=heap.ids == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(heap.ids), pa.int64()), ids, pa.array(heap.scores)], schema=BEST_ARROW
            )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int | None, Heap] = {}
        for row in rows_of(batches):
            lengths = np.frombuffer(row["lengths"], np.int64)
            lists = postings.Lists(row, lengths, part)
            ids = np.fromiter((NO_ID if x is None else x for x in row["ids"]), np.int64, len(row["ids"]))
            words = unpacked_words(row["words"])
            flat = numbers([t for q in row["queries"] for t in q["terms"]], words)
            at = 0
            for query in row["queries"]:
                mine = flat[at : at + len(query["terms"])]
                at += len(mine)
                heap = heaps.setdefault(query["id"], Heap(s.k))
                held = mine >= 0
                docs, scores = search(
                    lists, mine[held], np.asarray(query["weights"], np.int64)[held], s.k, heap.threshold
                )
                if len(docs):
                    heap.add(scores, ids[docs])
            if len(heaps) > s.task_queries:
                yield from out(heaps)
                heaps = {}
        yield from out(heaps)

    return run


def best(
    docs: DataFrame, queries: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
    query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """The ``k`` documents of the highest score for each query: ``item, rank, doc, score``."""
    s = settings
    held = index(docs, s, id_col, text_col)
    blocks, n, total = weighted(held, queries, s, query_id, query_text)
    wanted = ["ids", "lengths", "words", *postings.NAMES]
    met = with_blocks(held.filter("n_docs > 0").select("shard", *wanted), blocks).select(*wanted, "queries")
    found = met.mapInArrow(_search(s, n, max(1, total)), "item long, doc long, score long")
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc")))
    return found.withColumn("rank", rank).filter(F.col("rank") <= s.k).select("item", "rank", "doc", "score")
