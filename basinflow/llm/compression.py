"""Classifying text by how well zstandard dictionaries of two classes compress it.

Two dictionaries are built from a bounded sample of labelled documents. The ordinary one is trained by
zstandard on ordinary text. The other one holds the pieces of text that far more documents of the
target class have than ordinary ones, in front of the ordinary dictionary's content: text without
target features then compresses alike under both, and what a window saves is due to the target class.
A document is read in windows of words; each window is compressed under both dictionaries, and the
lengths become a few figures a document (largest saving, saving by size, share of windows that save,
compressed by raw size). A logistic curve, fitted to further labelled documents and weighted to the
classes' true shares, turns them into a score between 0 and 1.

Learning is bounded by ``Settings``; scoring reads whole texts, one row at a time.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinflow.llm.common import pieces, whole
from basinflow.session import ship_package


@dataclasses.dataclass(frozen=True)
class Settings:
    """Bounds and sizes. At most ``learn_docs`` documents per class are learned from, and no further one once those
    taken hold ``learn_bytes``; each is learned from whole. Scoring has no such bounds. ``gram_z`` is what a piece of
    text must reach in samples large enough; small samples ask for less, down to ``least_z``."""

    window_words: int = 24
    level: int = 6
    ordinary_bytes: int = 60_000
    target_bytes: int = 1_024
    learn_docs: int = 1_500
    learn_bytes: int = 16_000_000
    gram_sizes: tuple[int, ...] = (5, 6, 8)
    gram_z: float = 7.0
    least_z: float = 2.5
    gram_ratio: float = 8.0


def _line(text: str) -> bytes:
    return b" " + b" ".join(text.encode("utf-8", "replace").split()) + b" "


def _grams(line: bytes, size: int) -> np.ndarray:
    """The distinct byte strings of one size (at most 8), as numbers."""
    data = np.frombuffer(line, np.uint8).astype(np.uint64)
    if len(data) < size:
        return np.empty(0, np.uint64)
    found = np.zeros(len(data) - size + 1, np.uint64)
    for k in range(size):
        found |= data[k : len(found) + k] << np.uint64(8 * k)
    return np.unique(found)


def _document_counts(lines: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([_grams(x, size) for x in lines]), return_counts=True)


def _telling_pieces(target: list[bytes], ordinary: list[bytes], s: Settings) -> bytes:
    """Byte strings typical of the target class, the most telling last, without those held by others."""
    ranked = []
    bar = min(s.gram_z, max(s.least_z, 0.25 * len(target) ** 0.5))
    for size in s.gram_sizes:
        grams, here = _document_counts(target, size)
        others, counts = _document_counts(ordinary, size)
        if not len(grams) or not len(others):
            continue
        at = np.searchsorted(others, grams).clip(max=len(others) - 1)
        there = np.where(others[at] == grams, counts[at], 0) * (len(target) / len(ordinary))
        z = (here - there) / np.sqrt(here + there + 1)
        for i in np.flatnonzero((z >= bar) & (here >= s.gram_ratio * there)):
            ranked.append((z[i] * size**0.5, int(grams[i]).to_bytes(8, "little")[:size]))
    content = b""
    for _, gram in sorted(ranked, reverse=True):
        if len(content) >= s.target_bytes:
            break
        if gram not in content:
            content = gram + content
    return content


def _ordinary_content(lines: list[bytes], s: Settings) -> bytes:
    try:
        trained = zstandard.train_dictionary(s.ordinary_bytes + 2_000, lines)
        return trained.as_bytes()[-s.ordinary_bytes :]
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(lines)[-s.ordinary_bytes :]


class Scorer:
    """The two compressors of a model, made once per task."""

    def __init__(self, target: bytes, ordinary: bytes, s: Settings):
        self.words = s.window_words
        self.under_target = self._compressor(target + ordinary, s)
        self.under_ordinary = self._compressor(ordinary, s)

    @staticmethod
    def _compressor(content: bytes, s: Settings) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=s.level)
        return zstandard.ZstdCompressor(
            level=s.level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def _windows(self, text: str) -> Iterator[list[bytes]]:
        for part in pieces(text.encode("utf-8", "replace")):
            words = part.split()
            yield [
                b" " + b" ".join(words[i : i + self.words]) + b" " for i in range(0, len(words), self.words)
            ]

    def features(self, text: str) -> list[float]:
        """Eight figures of a text; one without words is taken as one empty window."""
        plain, told, raw = [], [], []
        for windows in self._windows(text):
            plain += map(len, map(self.under_ordinary.compress, windows))
            told += map(len, map(self.under_target.compress, windows))
            raw += map(len, windows)
        if not raw:
            plain, told, raw = [1], [1], [1]
        a, b, n = np.array(plain, float), np.array(told, float), np.array(raw, float)
        saved = a - b
        top = np.sort(saved)[::-1]
        return [
            top[0], top[:3].sum(), saved.sum() / n.sum() * 100, (saved >= 3).sum() / max(3, len(n)),
            a.sum() / (n.sum() + 1), b.sum() / (n.sum() + 1), np.log1p(len(n)), float(np.median(a / n)),
        ]


@dataclasses.dataclass(frozen=True)
class Model:
    """A fitted classifier: dictionaries of bounded size and the coefficients of the curve."""

    target: bytes
    ordinary: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    settings: Settings
    constant: float | None = None

    def scorer(self) -> Scorer:
        return Scorer(self.target, self.ordinary, self.settings)

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        """Probability of the target class."""
        return 1 / (1 + np.exp(-np.clip(_expanded(features, self.mean, self.spread) @ self.weights, -30, 30)))


def _expanded(features: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    x = np.clip((features - mean) / spread, -4, 4)
    return np.hstack([x, x**2, np.ones((len(x), 1))])


def _fitted_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def build(samples: Iterable[tuple[str, int]], shares: tuple[int, int], s: Settings) -> Model:
    """A model from ``(text, is target)`` pairs in no particular order; ``shares`` counts all labelled
    rows of (other, target)."""
    texts = {1: [], 0: []}
    for text, y in samples:
        texts[y].append(text)
    none = np.empty(0)
    if not texts[0] or not texts[1]:
        return Model(b"", b"", none, none, none, s, (shares[1] + 0.5) / (sum(shares) + 1.0))
    lines = {y: [_line(t) for t in found] for y, found in texts.items()}

    def content(part: slice) -> tuple[bytes, bytes]:
        told = {label: found[part] or found for label, found in lines.items()}
        return _telling_pieces(told[1], told[0], s), _ordinary_content(told[0], s)

    # Each half is judged with dictionaries of the other one, so the curve sees no text they were made
    # from; the dictionaries that stay are made of both.
    x, y = [], []
    for own, other in ((slice(0, None, 2), slice(1, None, 2)), (slice(1, None, 2), slice(0, None, 2))):
        scorer = Scorer(*content(other), s)
        for label in (0, 1):
            x += [scorer.features(t) for t in texts[label][own]]
            y += [label] * len(texts[label][own])
    x, y = np.array(x), np.array(y, float)
    target, ordinary = content(slice(None))
    mean, spread = x.mean(0), x.std(0) + 1e-9
    share = np.array([shares[k] / max(1, sum(shares)) * len(y) / max(1, (y == k).sum()) for k in (0, 1)])
    curve = _fitted_curve(_expanded(x, mean, spread), y, share[y.astype(int)])
    return Model(target, ordinary, mean, spread, curve, s)


def learn(
    docs: DataFrame, labels: DataFrame, label_col: str, target: int, usable: Column,
    id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(),
) -> Model:
    """Fit a model to documents with ``label_col`` 0 or 1, ``target`` being the class to detect.

    ``usable`` says which rows of ``labels`` may be learned from. Of each class the documents with the
    smallest hash of their id are taken, whole, up to the bounds of ``settings``; documents with contradictory
    labels, and labels without a document, are left out.
    """
    known = (
        labels.filter(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("most"))
        .filter("y = most").select("id", (F.col("y") == target).cast("int").alias("y"))
    )
    found = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = (F.xxhash64("id"), F.col("id"))
    chosen = [known.filter(F.col("y") == y).orderBy(*order).limit(settings.learn_docs) for y in (0, 1)]
    # At most 2 * learn_docs short rows: safe to send to every executor.
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).join(sample, "id")
    texts = texts.groupBy("id", "y").agg(F.min("text").alias("text"))
    before = W.partitionBy("y").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))
    rows = texts.withColumn("taken", taken).filter(F.col("taken") < settings.learn_bytes).collect()
    rows.sort(key=lambda r: (hash_order(r["id"]), r["id"]))
    return build(((r["text"], r["y"]) for r in rows), (found.get(0, 0), found.get(1, 0)), settings)


def hash_order(value: object) -> int:
    """A repeatable shuffle of ids."""
    import zlib

    return zlib.crc32(str(value).encode()[::-1])


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """``id, score`` per document, the score being the probability of the target class.

    With ``carry`` all columns of ``docs`` come first and the score is named ``_score``.
    """
    name = "_score" if carry else "score"
    chosen = docs if carry else docs.select(id_col, text_col)
    kept = list(range(len(docs.columns))) if carry else [0]
    column = docs.columns.index(text_col) if carry else 1
    # Columns go by place: names may hold dots, which Spark's Python functions cannot look up.
    rows = chosen.toDF(*[f"_{i}" for i in range(len(chosen.columns))])
    fields = [chosen.schema[i] for i in kept]
    schema = T.StructType([*fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if model.constant is not None else model.scorer()
        for batch in batches:
            if scorer is None:
                found = np.full(batch.num_rows, model.constant)
            elif not batch.num_rows:
                found = np.empty(0)
            else:
                texts = batch.column(column)
                found = model.probabilities(np.array([scorer.features(t.as_py() or "") for t in texts]))
            held = [batch.column(i) for i in kept]
            names = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([*held, pa.array(found, pa.float64())], names=[*names, name])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)
