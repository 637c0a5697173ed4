"""Near-dedup of embeddings with a robust-pruned flat graph.

Vectors are linked when their labels are equal and the cosine reaches the threshold, in double precision.

1. Equal vectors of a label form one class, counted once from here on.
2. Labels are cut into shards of bounded size by centroids fitted to bounded samples, level by level. A
   vector goes to every shard whose centroid is nearly as close as its closest, so shards overlap.
3. In each shard every vector gets neighbours by robust pruning: of its closest vectors and some distant
   ones, those that no chosen neighbour is much closer to. Back edges are added, and vectors that the
   medoid cannot reach get an edge from the closest one it can.
4. The lists of a vector from all its shards are united.
5. In each shard, every vector searches from the medoid and from its own place, greedily with a beam; then
   the search expands every vector within range of the threshold until none is left. Links are verified by their cosine.
   A pair that shares several shards is counted in the first of them.
6. A bounded sample of vectors, spread over groups of all sizes, is compared with all vectors. Recall is the mean
   over the sampled vectors of the share of their links that was found, so small groups count like large ones.
   Below ``recall`` the job repeats with wider overlap and beam, and fails if the last attempt is below ``floor``.
7. Each shard passes on a spanning forest of its links; large-star and small-star make components.

A shard is divided only if its parts together hold fewer pairs than it does. A dense group, whose vectors
would go to nearly every part, is not: it is cut into blocks of bounded size, and each pair of blocks is a
task that compares all vectors, counts its links and passes on a spanning forest. The same happens to what is
still large after ``levels`` rounds. So no round multiplies pairs, and no task holds more than two blocks; a
group in which all are linked to all still has a square number of links to count.

Defined results: rows whose id, label or vector is null, and vectors of no length or with null or
non-finite components, are linked with nothing and keep their row. Vectors of different dimensions are
not compared. Rows that share an id share a component. Further columns are ignored. No rows give no rows.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinflow.llm.components import components
from basinflow.session import cut, ship_package


@dataclasses.dataclass(frozen=True)
class Settings:
    """``shard`` is the size shards are cut down to, ``fit_rows`` the sample of a shard that centroids are
    fitted to, ``overlap`` an angle in radians, ``audit`` the number of vectors, or up
    to twice as many, that recall is measured on."""

    threshold: float = 0.93
    shard: int = 1_000
    fit_rows: int = 4_000
    branches: int = 16
    levels: int = 6
    overlap: float = 0.1
    degree: int = 20
    near: int = 40
    far: int = 12
    alpha: float = 1.2
    beam: int = 24
    slack: float = 0.08
    audit: int = 200
    recall: float = 0.99
    floor: float = 0.9
    attempts: int = 4


# ------------------------------------------------------------------------------------- inside a shard


def robust_graph(x: np.ndarray, s: Settings, seed: int = 1) -> tuple[np.ndarray, int]:
    """Neighbours of each row of ``x`` (unit vectors), -1 for none, and the medoid."""
    m = len(x)
    start = int(np.argmax(x @ x.mean(0)))
    if m == 1:
        return np.full((1, 1), -1), 0
    random = np.random.default_rng(seed)
    near, far = min(s.near, m - 1), min(s.far, m - 1)
    edges = []
    for a in range(0, m, 256):
        own = np.arange(a, min(a + 256, m))
        sims = x[own] @ x.T
        sims[np.arange(len(own)), own] = -2
        close = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        some = np.hstack([close, random.integers(0, m, (len(own), far))])
        value = np.take_along_axis(sims, some, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        some, value = np.take_along_axis(some, order, 1), np.take_along_axis(value, order, 1)
        alive = value > -2
        vectors, row = x[some], np.arange(len(own))
        for _ in range(s.degree):
            pick = alive.argmax(1)
            has = alive[row, pick]
            if not has.any():
                break
            chosen = some[row, pick]
            edges.append(np.column_stack([own[has], chosen[has]]))
            between = np.einsum("ncd,nd->nc", vectors, x[chosen])
            alive &= ~((s.alpha * (1 - between) <= 1 - value) | (some == chosen[:, None]))
    pairs = np.concatenate(edges)
    both = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
    graph = _lists(both, x, 2 * s.degree, s.threshold - s.slack)
    while True:
        reached = _reached(graph, start)
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return graph, start
        # Some of the lost get an edge from the closest vector in reach; what hangs on them follows.
        there = np.flatnonzero(reached)
        sims = x[lost[:256]] @ x[there].T
        bridge = np.column_stack([there[sims.argmax(1)], lost[:256]])
        wide = np.full((m, graph.shape[1] + len(bridge)), -1)
        wide[:, : graph.shape[1]] = graph
        filled = (graph >= 0).sum(1)
        for a, b in bridge:
            wide[a, filled[a]] = b
            filled[a] += 1
        graph = wide[:, : max(1, filled.max())]


def _lists(pairs: np.ndarray, x: np.ndarray, most: int, reach: float) -> np.ndarray:
    """Adjacency as rows of neighbours: the closest ``most`` of each, and all closer than ``reach``, so that
    within range every edge can be walked both ways."""
    value = np.einsum("pd,pd->p", x[pairs[:, 0]], x[pairs[:, 1]])
    order = np.lexsort((-value, pairs[:, 0]))
    pairs, value = pairs[order], value[order]
    first = np.searchsorted(pairs[:, 0], np.arange(len(x)))
    place = np.arange(len(pairs)) - first[pairs[:, 0]]
    good = (place < most) | (value >= reach)
    graph = np.full((len(x), max(most, int(place[good].max(initial=0)) + 1)), -1)
    graph[pairs[good, 0], place[good]] = pairs[good, 1]
    return graph


def _reached(graph: np.ndarray, start: int) -> np.ndarray:
    reached = np.zeros(len(graph), bool)
    reached[start] = True
    front = np.array([start])
    while len(front):
        found = np.unique(graph[front])
        front = found[(found >= 0) & ~reached[found]]
        reached[front] = True
    return reached


def range_search(x: np.ndarray, graph: np.ndarray, start: int, s: Settings) -> np.ndarray:
    """Pairs of rows whose cosine reaches the threshold, as found by searching from every row."""
    m = len(x)
    out = []
    for a in range(0, m, 512):
        own = np.arange(a, min(a + 512, m))
        sims = _beam(x, graph, start, own, s)
        opened = np.zeros(sims.shape, bool)
        reach = s.threshold - s.slack
        front = np.argwhere(sims >= reach)
        while len(front):
            opened[front[:, 0], front[:, 1]] = True
            for b in range(0, len(front), 20_000):
                some = front[b : b + 20_000]
                after = graph[some[:, 1]]
                query = np.repeat(some[:, 0], after.shape[1])
                node = after.ravel()
                new = node >= 0
                query, node = query[new], node[new]
                new = sims[query, node] < -1.5
                flat = np.unique(query[new] * m + node[new])
                query, node = flat // m, flat % m
                for c in range(0, len(flat), 100_000):
                    q, n = query[c : c + 100_000], node[c : c + 100_000]
                    sims[q, n] = np.einsum("pd,pd->p", x[own[q]], x[n])
            front = np.argwhere((sims >= reach) & ~opened)
        found = np.argwhere(sims >= s.threshold)
        found[:, 0] += a
        out.append(found[found[:, 0] != found[:, 1]])
    pairs = np.concatenate(out)
    return np.unique(np.sort(pairs, axis=1), axis=0)


def _beam(x: np.ndarray, graph: np.ndarray, start: int, own: np.ndarray, s: Settings) -> np.ndarray:
    """Greedy search with a beam: cosines of the vectors met, -2 for the others."""
    rows = np.arange(len(own))
    sims = np.full((len(own), len(x)), -2.0)
    nodes, values = np.full((len(own), s.beam), start), np.full((len(own), s.beam), -2.0)
    opened = np.ones((len(own), s.beam), bool)
    values[:, 0] = sims[:, start] = x[own] @ x[start]
    opened[:, 0] = False
    # The query is a vertex itself: its own list is the other place to start from.
    nodes[:, 1], values[:, 1], opened[:, 1] = own, 1.0, own == start
    sims[rows, own] = 1.0
    active = rows
    while True:
        todo = np.where(opened[active], -3.0, values[active])
        best = todo.argmax(1)
        going = todo[np.arange(len(active)), best] > -2
        active, best = active[going], best[going]
        if not len(active):
            return sims
        opened[active, best] = True
        after = graph[nodes[active, best]]
        fresh = (after >= 0) & (sims[active[:, None], after] < -1.5)
        r, c = np.nonzero(fresh)
        found = np.full(after.shape, -2.0)
        found[r, c] = np.einsum("pd,pd->p", x[own[active[r]]], x[after[r, c]])
        sims[active[r], after[r, c]] = found[r, c]
        all_values = np.hstack([values[active], found])
        keep = np.argpartition(-all_values, s.beam - 1, axis=1)[:, : s.beam]
        values[active] = np.take_along_axis(all_values, keep, 1)
        nodes[active] = np.take_along_axis(np.hstack([nodes[active], after]), keep, 1)
        opened[active] = np.take_along_axis(np.hstack([opened[active], found <= -2]), keep, 1)


def _roots(m: int, pairs: np.ndarray) -> np.ndarray:
    """The least row reachable from each row."""
    root = np.arange(m)
    while len(pairs):
        least = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        np.minimum.at(root, pairs[:, 0], least)
        np.minimum.at(root, pairs[:, 1], least)
        root = root[root]
        if (root == before).all():
            break
    return root


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.array(rows.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# ------------------------------------------------------------------------------------------ the job


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Comparable vectors with the class they belong to, and the classes."""
    v = F.col("v")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    size = F.aggregate(v, F.lit(0.0), lambda t, e: t + e * e)
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull())
    rows = rows.filter(~bad).filter((size > 0) & (size < float("inf")))
    rows = rows.withColumn("one", F.xxhash64("label", "v")).withColumn("two", F.xxhash64(F.lit(1), "v", "label"))
    classes = rows.groupBy("one", "two").agg(
        F.min(F.struct("id", "label", "v")).alias("least"), F.count("*").alias("n"),
    )
    return rows.select("id", "one", "two"), classes.select("one", "two", "least.*", "n")


def _shards(classes: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """``shard, id, n, v``: every class in one or more shards; and those of them that stay large, with ``blocks``."""
    held = cut(classes.select(
        F.concat_ws(":", F.col("label").cast("string"), F.size("v")).alias("shard"), "id", "n", "v",
    ), "vector-shards")

    def smaller(x: np.ndarray, centre: np.ndarray) -> bool:
        """Whether the parts together hold fewer pairs than the whole."""
        angle = np.arccos(np.clip(x @ centre.T, -1, 1))
        parts = (angle <= angle.min(1, keepdims=True) + s.overlap).mean(0)
        return bool((parts**2).sum() < 1)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        x = _unit(group["v"])
        k = int(min(s.branches, -(-int(group["rows"].iloc[0]) // s.shard), len(x)))
        centre = x[np.random.default_rng(1).choice(len(x), k, replace=False)]
        for _ in range(10):
            nearest = (x @ centre.T).argmax(1)
            for i in range(k):
                if (nearest == i).any():
                    mean = x[nearest == i].mean(0)
                    centre[i] = mean / max(1e-12, np.linalg.norm(mean))
        divides = smaller(x, centre)
        if not divides:
            # Centres that fell into one dense group count as one, so that the rest can leave it.
            apart = [0]
            for i in range(1, k):
                if (np.arccos(np.clip(centre[apart] @ centre[i], -1, 1)) > 2 * s.overlap).all():
                    apart.append(i)
            centre = centre[apart]
            divides = smaller(x, centre)
        return pd.DataFrame({
            "shard": [group["shard"].iloc[0]], "centres": [centre.ravel().tolist()], "divides": [divides],
        })

    def dealt(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or found.empty:
            return pd.DataFrame({"shard": [], "id": [], "n": [], "v": []})
        x = _unit(rows["v"])
        centre = np.array(found["centres"].iloc[0]).reshape(-1, x.shape[1])
        angle = np.arccos(np.clip(x @ centre.T, -1, 1))
        r, c = np.nonzero(angle <= angle.min(1, keepdims=True) + s.overlap)
        some = rows.iloc[r]
        return pd.DataFrame({
            "shard": [f"{a}/{b}" for a, b in zip(some["shard"], c)], "id": some["id"].to_numpy(),
            "n": some["n"].to_numpy(), "v": some["v"].to_numpy(),
        })

    def sizes(rows: DataFrame) -> DataFrame:
        return cut(rows.groupBy("shard").agg(F.count("*").alias("rows")).filter(F.col("rows") > 2 * s.shard), "vector-large")

    def blocked(rows: DataFrame, large: DataFrame) -> DataFrame:
        return rows.join(large.select("shard", F.ceil(F.col("rows") / (2 * s.shard)).alias("blocks")), "shard")

    done, dense = None, blocked(held, sizes(held)).limit(0)
    for _ in range(s.levels):
        large = sizes(held)
        if large.isEmpty():
            break
        small = held.join(large, "shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = held.join(large, "shard")
        every = F.greatest(F.lit(1), F.col("rows") / s.fit_rows).cast("long")
        sample = rows.filter(F.pmod(F.xxhash64("id"), every) == 0)
        found = cut(sample.groupBy("shard").applyInPandas(
            centroids, "shard string, centres array<double>, divides boolean"
        ), "vector-centres")
        divided = found.filter("divides").drop("divides")
        dense = dense.unionByName(blocked(held, large.join(divided, "shard", "left_anti")))
        chunks = F.ceil(F.col("rows") / (4 * s.shard))
        rows = rows.join(divided.select("shard"), "shard")
        rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(2)), chunks)).drop("rows")
        divided = divided.join(large, "shard").withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).drop("rows")
        keys = ("shard", "chunk")
        held = cut(rows.groupBy(*keys).cogroup(divided.groupBy(*keys)).applyInPandas(
            dealt, "shard string, id long, n long, v array<double>"
        ), "vector-shards")
    else:
        large = sizes(held)
        dense = dense.unionByName(blocked(held, large))
        held = held.join(large, "shard", "left_anti")
    return held if done is None else done.unionByName(held), dense


def block_links(
    x: np.ndarray, y: np.ndarray, own: np.ndarray, other: np.ndarray, before: tuple[np.ndarray, np.ndarray] | None,
    threshold: float, same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows of ``x`` against all of ``y``: links of each, weighted by the counts ``own`` and ``other``, and
    the least row of ``x`` followed by ``y`` that each row hangs on. ``same`` says that ``y`` is ``x``.

    ``before`` tells for the rows of both which earlier shards hold them: pairs that share one are linked, not counted.
    """
    m = len(x) if same else len(x) + len(y)
    to_x, to_y = np.zeros(len(x)), np.zeros(len(y))
    root = np.arange(m)
    for a in range(0, len(x), 256):
        near = x[a : a + 256] @ y.T >= threshold
        if same:
            near &= np.arange(a, a + len(near))[:, None] < np.arange(len(y))[None, :]
        r, c = np.nonzero(near)
        if not len(r):
            continue
        root = _roots(m, np.vstack([
            np.column_stack([r + a, c if same else c + len(x)]), np.column_stack([np.arange(m), root]),
        ]))
        if before is not None:
            near &= before[0][a : a + 256] @ before[1].T == 0
        counted = near.astype(np.float64)
        to_x[a : a + 256] += counted @ other
        to_y += counted.T @ own[a : a + 256]
    return to_x.astype(np.int64), to_y.astype(np.int64), root


def _block_search(dense: DataFrame, shards: DataFrame, s: Settings) -> DataFrame:
    """``id, links, root`` per class and pair of blocks of the shards that stay large."""

    def earlier(rows: pd.DataFrame, names: list[str]) -> np.ndarray:
        return np.array([np.isin(names, t) for t in rows["shards"]], np.float64)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        p, q = int(group["p"].iloc[0]), int(group["q"].iloc[0])
        left, right = group[group["block"] == p], group[group["block"] == q]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "links": [], "root": []})
        shard = group["shard"].iloc[0]
        names = sorted({t for many in group["shards"] for t in many if t < shard})
        before = (earlier(left, names), earlier(right, names)) if names else None
        to_left, to_right, root = block_links(
            _unit(left["v"]), _unit(right["v"]), left["n"].to_numpy(), right["n"].to_numpy(), before, s.threshold, p == q,
        )
        if p == q:
            ids, links = left["id"].to_numpy(), to_left + to_right
        else:
            ids = np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()])
            links = np.concatenate([to_left, to_right])
        # Within its own block every class keeps a row, so that none is lost.
        told = (links > 0) | (root != np.arange(len(ids))) | (p == q)
        return pd.DataFrame({"id": ids[told], "links": links[told], "root": ids[root[told]]})

    rows = dense.join(shards, "id").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    rows = rows.select("shard", "p", "q", "block", "id", "n", "v", "shards")
    return rows.groupBy("shard", "p", "q").applyInPandas(compare, "id long, links long, root long")


def _search(shards: DataFrame, dense: DataFrame, s: Settings) -> DataFrame:
    """``id, links, root`` per class and shard, or pair of blocks: links counted there, and the class it hangs on."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        ids = group["id"].to_numpy()
        graph, _ = robust_graph(_unit(group["v"]), s)
        return pd.DataFrame({
            "id": ids, "shard": group["shard"].to_numpy(), "after": [ids[row[row >= 0]].tolist() for row in graph],
        })

    def search(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id").reset_index(drop=True)
        ids, counts, x = group["id"].to_numpy(), group["n"].to_numpy(), _unit(group["v"])
        start = int(np.argmax(x @ x.mean(0)))
        lists = [np.asarray(a, np.int64) for a in group["after"]]
        place = [np.searchsorted(ids, a).clip(max=len(ids) - 1) for a in lists]
        place = [p[ids[p] == a] for p, a in zip(place, lists)]
        graph = np.full((len(ids), max(1, max(map(len, place)))), -1)
        for i, p in enumerate(place):
            graph[i, : len(p)] = p
        pairs = range_search(x, graph, start, s)
        shard, among = group["shard"].iloc[0], [sorted(t) for t in group["shards"]]
        alone = np.array([len(t) == 1 for t in among])
        first = alone[pairs[:, 0]] | alone[pairs[:, 1]] if len(pairs) else np.empty(0, bool)
        for i in np.flatnonzero(~first):
            a, b = pairs[i]
            first[i] = min(set(among[a]) & set(among[b])) == shard
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, pairs[first, 0], counts[pairs[first, 1]])
        np.add.at(links, pairs[first, 1], counts[pairs[first, 0]])
        return pd.DataFrame({"id": ids, "links": links, "root": ids[_roots(len(ids), pairs)]})

    lists = shards.groupBy("shard").applyInPandas(build, "id long, shard string, after array<long>")
    lists = lists.unionByName(dense.select("id", "shard", F.array().cast("array<long>").alias("after")))
    united = lists.groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_list("after"))).alias("after"), F.collect_set("shard").alias("shards"),
    )
    found = shards.join(united, "id").groupBy("shard").applyInPandas(search, "id long, links long, root long")
    return found.unionByName(_block_search(dense, united.select("id", "shards"), s))


def _audited(classes: DataFrame, links: DataFrame, s: Settings) -> list:
    """A bounded sample of classes, as even as can be over powers of two of the links found; none is one of them."""
    found = F.coalesce(F.col("links"), F.lit(0))
    size = F.when(found > 0, F.floor(F.log2(found))).otherwise(-1).cast("int")
    sized = classes.join(links, "id", "left").withColumn("size", size)
    counts = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most 64
    left, share = s.audit, {}
    for place, (power, n) in enumerate(sorted(counts.items(), key=lambda c: c[1])):
        share[power] = max(1, min(n, left // (len(counts) - place)))
        left -= share[power]
    taken = F.lit(False)
    for power, n in counts.items():
        taken |= (F.col("size") == power) & (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(n // share[power])) == 0)
    return sized.filter(taken).select("id", "label", "v").collect()  # about twice ``audit`` at most


def _recall(expected: DataFrame, links: DataFrame) -> float:
    """Mean over the classes that should have links of the share found."""
    share = F.least(F.coalesce("links", F.lit(0)), "expected") / F.col("expected")
    seen = expected.filter("expected > 0").join(links, "id", "left").agg(F.avg(share)).first()[0]
    return 1.0 if seen is None else seen


def _true_links(classes: DataFrame, sample: list, s: Settings) -> DataFrame:
    """``id, expected`` for a bounded sample of classes, by comparing them with all classes."""
    ids = np.array([r["id"] for r in sample], np.int64)
    labels, held = [r["label"] for r in sample], [np.array(r["v"]) / np.linalg.norm(r["v"]) for r in sample]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            rows = batch.to_pandas()
            for (label, size), group in rows.groupby(["label", rows["v"].map(len)]):
                mine = [i for i in range(len(ids)) if labels[i] == label and len(held[i]) == size]
                if mine:
                    close = np.array([held[i] for i in mine]) @ _unit(group["v"]).T >= s.threshold
                    close &= ids[mine][:, None] != group["id"].to_numpy()[None, :]
                    total[mine] += close @ group["n"].to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "expected"])

    counted = classes.select("id", "label", "n", "v").mapInArrow(run, "id long, expected long")
    return counted.groupBy("id").agg(F.sum("expected").alias("expected"))


def near_duplicates(
    vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per vector: id, ``n_links, component_id, kept``."""
    s = settings
    ship_package(vectors.sparkSession)
    rows, classes = _classes(vectors, id_col, vector_col, label_col)
    classes = cut(classes, "vector-classes")
    for attempt in range(s.attempts):
        found = cut(_search(*_shards(classes, s), s), "vector-links")
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        recall = _recall(_true_links(classes, _audited(classes, links, s), s), links)
        if recall >= s.recall:
            break
        if attempt + 1 == s.attempts:
            if recall >= s.floor:
                break
            raise RuntimeError(f"recall {recall} is below {s.floor}")
        s = dataclasses.replace(s, overlap=2 * s.overlap, beam=2 * s.beam, near=2 * s.near)
    named = components(found.select("id", "root"), "id", "root")
    named = named.withColumnRenamed("id", "class_id")
    per_class = classes.select("one", "two", F.col("id").alias("class_id"), "n").join(
        links.withColumnRenamed("id", "class_id"), "class_id"
    ).join(named, "class_id", "left").select(
        "one", "two", (F.col("links") + F.col("n") - 1).alias("links"),
        F.coalesce("component", "class_id").alias("component"),
    )
    linked = rows.join(per_class, ["one", "two"]).groupBy("id").agg(
        F.max("links").alias("links"), F.min("component").alias("component")
    ).withColumnRenamed("id", "_linked")
    return vectors.select(F.col(id_col)).join(linked, F.col(id_col) == F.col("_linked"), "left").select(
        id_col, F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", F.col(id_col)).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
