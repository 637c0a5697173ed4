"""MinHash near-dedup.

Words are lower-cased in A-Z only. A document's set holds its distinct shingles of ``shingle`` words;
with fewer words the whole sequence is one shingle; without words the set is empty. Documents are
linked when intersection / union of their sets reaches the threshold, and components of links are
groups.

1. Each set gets ``bands * rows`` minima under universal hash functions, a hash per band, and one byte
   per minimum as its signature. Documents with equal sets form one class from here on; each is compared
   in full with the one of least id.
2. Classes that share a band hash form a bucket. Each class is first compared, on both whole sets, with
   the least of those it shares a bucket with. Large-star and small-star make components of the links.
3. Buckets that still hold classes of several components are gone through by signatures: a task holds a
   bucket, or two blocks of a large one. Pairs of blocks within one component are left out. What has no partner of another
   component whose estimated similarity may reach the threshold is done.
4. The others meet again with their texts. Pairs are compared on whole sets in order of their estimates,
   each in the first bucket it shares, and united at once if similar enough: pairs united already are
   passed over. A task returns a spanning forest, fewer links than it read rows. So every pair
   that shares a bucket and may reach the threshold is compared, unless links already connect it.
5. Large-star and small-star make components of all links.

With 40 bands of 5 rows a pair at 0.8 is missed with probability 1e-7, and less above.

Defined results: null and empty texts have no shingles and are linked with nothing. Rows without id
are linked with nothing. Rows that share an id count as one document. Equal texts always group. Further
columns are ignored; ``dedup`` carries them. No rows give no rows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basinflow.llm.common import pieces
from basinflow.llm.components import components
from basinflow.session import cut, ship_package

REMEMBERED = 1_000_000  # words kept per Python worker
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclasses.dataclass(frozen=True)
class Settings:
    """``threshold`` is in hundredths; ``margin`` is how far a signature's estimate may lie below it;
    ``block`` is how many classes of a large bucket a task compares with as many others, and
    ``block_chars`` how many characters their texts hold together, about, as a hash deals them to blocks."""

    shingle: int = 5
    threshold: int = 80
    bands: int = 40
    rows: int = 5
    margin: float = 0.15
    block: int = 1_000
    block_chars: int = 1 << 24
    seed: int = 1


class Words(dict):
    """Hashes of words already met; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORDS = Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """The set of a text as sorted 64-bit numbers."""
    parts = []
    for part in pieces(text.encode("utf-8", "replace").lower()):
        words = part.split()
        parts.append(np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words)))
    words = np.concatenate(parts)
    if not len(words):
        return words
    k = min(k, len(words))
    total = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        total = (total + words[i : len(words) - k + 1 + i]) * MIX + np.uint64(i)
        total ^= total >> np.uint64(31)
    return np.unique(_mixed(total))


def same_enough(a: str, b: str, k: int, threshold: int) -> bool:
    """Whether the whole sets of two texts are similar enough, exactly."""
    if a == b:
        return bool(a.encode("utf-8", "replace").split(None, 1))
    left, right = _shingles(a, k), _shingles(b, k)
    both = len(left & right)
    return bool(left) and bool(right) and 100 * both >= threshold * (len(left) + len(right) - both)


def _shingles(text: str, k: int) -> set:
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return set()
    k = min(k, len(words))
    return set(zip(*[words[i : len(words) - k + 1 + i] for i in range(k)]))


def signatures(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, key, bands, signature, size`` per document; equal sets have equal keys, ``size`` is in characters."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("signature", T.BinaryType()), T.StructField("size", T.LongType()),
    ])
    count = s.bands * s.rows

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(s.seed)
        factor = random.integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
        shift = random.integers(0, 2**63, count, np.uint64)[:, None]
        number = np.arange(s.bands, dtype=np.uint64)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for row in batch.column(1):
                text = row.as_py() or ""
                found = shingle_hashes(text, s.shingle)
                least = np.full(count, np.uint64(2**64 - 1))
                for start in range(0, len(found), 1024):
                    least = np.minimum(
                        least, (np.multiply.outer(factor, found[start : start + 1024]) + shift).min(1)
                    )
                least = _mixed(least)
                band = number.copy()
                for column in least.reshape(s.bands, s.rows).T:
                    band = _mixed((band + column) * MIX)
                out[0].append(len(found))
                out[1].append(xxhash.xxh3_128_digest(found.tobytes()))
                out[2].append(band.view(np.int64))
                out[3].append((least >> np.uint64(56)).astype(np.uint8).tobytes())
                out[4].append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                 pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary()), pa.array(out[4], pa.int64())],
                names=[f.name for f in schema],
            )

    ship_package(docs.sparkSession)
    return rows.mapInArrow(run, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough; ``texts (id, text)``."""
    k, threshold = s.shingle, s.threshold
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("two"))
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("one"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                same_enough(x.as_py() or "", y.as_py() or "", k, threshold)
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(two, "b").join(one, "a").select("a", "b", "one", "two")
    return both.mapInArrow(run, T.StructType([pairs.schema["a"], pairs.schema["b"]])).distinct()


def told_apart(sets: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """``sets`` with a key of its own for each document whose whole set differs from that of the document of
    least id with the same key; ``texts (id, text)``."""
    linkable = sets.filter("n > 0 AND id IS NOT NULL").select("key", "id")
    first = linkable.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("most")).filter("a < most")
    pairs = linkable.join(first, "key").filter("id <> a").select("a", F.col("id").alias("b"))
    pairs = cut(pairs.distinct(), "minhash-equal")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    good = confirmed(pairs, texts.join(wanted, "id", "left_semi"), s)
    other = cut(pairs.join(good, ["a", "b"], "left_anti").select(F.col("b").alias("id")).distinct(), "minhash-other")
    if other.isEmpty():
        return sets
    own = F.concat("key", F.col("id").cast("string").cast("binary"))
    alone = sets.join(other, "id", "left_semi").withColumn("key", own)
    rest = sets.join(other, "id", "left_anti")
    return cut(rest.unionByName(alone.select(*sets.columns)), "minhash-sets")


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of each row of ``x`` with each of ``y``, rows being signatures."""
    agree = np.empty((len(x), len(y)))
    for i in range(len(x)):
        agree[i] = (y == x[i]).mean(1)
    return (agree - 1 / 256) / (1 - 1 / 256)


PLACE = "bucket long, one long, two long, block long, id long, component long"


def _candidates(rows: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows, and their estimates, that may reach the threshold: from different components, of the
    two blocks (or the one), in the first bucket that both share."""
    found, mine = rows.column("component").to_numpy(), rows.column("block").to_numpy()
    marks = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(found), -1)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(found), -1)
    bucket, one, two = (rows.column(name)[0].as_py() for name in ("bucket", "one", "two"))
    left, right = np.flatnonzero(mine == one), np.flatnonzero(mine == two)
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for start in range(0, len(left) if len(right) else 0, 256):
        some = left[start : start + 256]
        value = estimates(marks[some], marks[right])
        value[found[some][:, None] == found[right][None, :]] = -1
        if one == two:
            value[some[:, None] >= right[None, :]] = -1
        i, j = np.nonzero(value >= least)
        value, i, j = value[i, j], some[i], right[j]
        keep = bands[i, (bands[i] == bands[j]).argmax(1)] == bucket
        parts.append((i[keep], j[keep], value[keep]))
    i, j, value = (np.concatenate(x) for x in zip(*parts))
    return i, j, value


def _with_partner(least: float):
    """The rows of a bucket, or of two blocks of one, that have a candidate."""

    def run(rows: pa.Table) -> pa.Table:
        i, j, _ = _candidates(rows, least)
        return rows.take(np.unique(np.concatenate([i, j]))).select(["bucket", "one", "two", "block", "id", "component"])

    return run


def _forest(least: float, k: int, threshold: int):
    """Links that unite what is similar enough in a bucket, or in two blocks of one, none of them closing a circle."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("id")
        i, j, value = _candidates(rows, least)
        order = np.argsort(-value, kind="stable")
        group, texts, sets = rows.column("component").to_numpy().copy(), rows.column("text"), {}

        def text(x: int) -> str:
            return texts[x].as_py() or ""

        def similar(a: int, b: int) -> bool:
            for x in (a, b):
                if x not in sets:
                    sets[x] = shingle_hashes(text(x), k)
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small < threshold * large:
                return False
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            return 100 * both >= threshold * (small + large - both) and same_enough(text(a), text(b), k, threshold)

        links = []
        for start in range(0, len(order), 4096):
            some = order[start : start + 4096]
            some = some[group[i[some]] != group[j[some]]]
            for a, b in zip(i[some].tolist(), j[some].tolist()):
                if group[a] != group[b] and similar(a, b):
                    group[group == group[b]] = group[a]
                    links.append((a, b))
        ids = rows.column("id").to_numpy()
        chosen = ids[np.array(links, np.int64).reshape(-1, 2)]
        return pa.table({"a": chosen.min(1), "b": chosen.max(1)})

    return run


def further_links(
    members: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, s: Settings
) -> DataFrame | None:
    """Links ``a, b`` between components that share a bucket, None when no bucket holds several components.

    ``members (bucket, id, size)``, ``classes (id, bands, signature)``, ``labels (id, component)``,
    ``texts (id, text)``. Links join what is similar enough and not connected yet, within one bucket.
    """
    least = s.threshold / 100 - s.margin
    several = "least < most"
    ends = F.min("component").alias("least"), F.max("component").alias("most")
    placed = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    blocks = F.greatest(F.ceil(F.count("*") / s.block), F.ceil(F.sum("size") / s.block_chars)).alias("blocks")
    mixed = placed.groupBy("bucket").agg(*ends, blocks).filter(several).select("bucket", "blocks")
    placed = placed.join(mixed, "bucket").select(
        "bucket", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "component"
    )
    placed = cut(placed, "minhash-placed")
    parts = placed.groupBy("bucket", "block").agg(*ends)
    others = parts.select("bucket", F.col("block").alias("two"), F.col("least").alias("l"), F.col("most").alias("m"))
    meet = parts.withColumnRenamed("block", "one").join(others, "bucket").filter(
        "one <= two AND least(least, l) < greatest(most, m)"
    ).select("bucket", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    meet = cut(meet, "minhash-meet")
    if meet.isEmpty():
        return None
    marks = classes.select("id", "bands", "signature")
    columns = ["bucket", "one", "two", "block", "id", "component"]
    rows = placed.join(meet, ["bucket", "block"]).join(marks, "id").select(*columns, "bands", "signature")
    rows = rows.groupBy("bucket", "one", "two").applyInArrow(_with_partner(least), PLACE)
    rows = cut(rows, "minhash-partners").join(marks, "id").join(texts, "id").select(*columns, "bands", "signature", "text")
    return rows.groupBy("bucket", "one", "two").applyInArrow(
        _forest(least, s.shingle, s.threshold), "a long, b long"
    ).distinct()


def groups(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_shingles, component_id, kept``."""
    s = settings
    sets = cut(signatures(docs, s, id_col, text_col), "minhash-sets")
    sets = told_apart(sets, docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), s)
    linkable = sets.filter("n > 0 AND id IS NOT NULL")
    classes = linkable.groupBy("key").agg(F.min(F.struct("id", "bands", "signature", "size")).alias("first"))
    classes = cut(classes.select("key", "first.*"), "minhash-classes")
    banded = classes.select("id", "size", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
    members = cut(
        banded.join(buckets.filter("hub < last"), "bucket").select("bucket", "id", "size", "hub"), "minhash-members"
    )
    wanted = members.select("id").distinct()
    texts = cut(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi"),
        "minhash-texts",
    )
    first = members.filter("id <> hub").groupBy(F.col("id").alias("b")).agg(F.min("hub").alias("a"))
    links = cut(confirmed(first.select("a", "b"), texts, s), "minhash-links")
    labels = cut(components(links), "minhash-labels")
    members = members.select("bucket", "id", "size").distinct()
    found = further_links(members, classes, labels, texts, s)
    if found is not None:
        links = links.unionByName(cut(found, "minhash-links"))
        labels = cut(components(links), "minhash-labels")
    named = classes.select("key", F.col("id").alias("class_id")).join(
        labels.withColumnRenamed("id", "class_id"), "class_id", "left"
    ).select("key", F.coalesce("component", "class_id").alias("component"))
    found = sets.select("id", "n", "key").join(named, "key", "left")
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def dedup(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group, the one with the least id, with all its columns."""
    found = cut(groups(docs, settings, id_col, text_col), "minhash-groups")
    gone = found.filter(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct()
    left = docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
    again = found.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_again")).count()
    again = cut(again.filter("count > 1").select("_again"), "minhash-again")
    if again.isEmpty():
        return left
    same = F.col(id_col) == F.col("_again")
    once = left.join(again, same, "left_semi").dropDuplicates([id_col])
    return left.join(again, same, "left_anti").unionByName(once)
