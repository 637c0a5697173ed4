"""MinHash, components and embeddings against brute force."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from odd import empty_docs, odd_docs, odd_rows, prose

from pyspark.sql import functions as F

from basinflow.llm import minhash, vectors
from basinflow.llm.components import components


def least_reachable(nodes, links):
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            for x in (a, b):
                if found[x] != low:
                    found[x], changed = low, True
    return found


def shingles(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return set()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_groups(rows, k, threshold=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    links = []
    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None], 2):
        if x and y and 100 * len(x & y) >= threshold * len(x | y):
            links.append((a, b))
    return least_reachable([i for i, _ in rows if i is not None], links)


def check_groups(got, rows, k):
    want = brute_groups(rows, k)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id), r
    sizes = {i: len(shingles(t, k)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in found if r.doc_id is not None)


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 3), (3, 1)], [(i, i + 1) for i in range(40)], [(9, i) for i in range(30)],
    [(random.Random(i).randrange(60), random.Random(-i).randrange(60)) for i in range(50)],
])
def test_components(spark, links):
    df = spark.createDataFrame(links + [(None, 5)], "a long, b long")
    got = {r.id: r.component for r in components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == {k: v for k, v in least_reachable(nodes, [x for x in links if x[0] != x[1]]).items()}


def varied(seed, groups=6, copies=14):
    """Groups whose members differ from each other about as much as the threshold allows."""
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = prose(100 * seed + g, 150, 300).split()
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = "".join(rng.choice("xyz") for _ in range(6))
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, block", [(1, 1000), (2, 3)])
def test_minhash_near_the_threshold(spark, seed, block):
    rows = varied(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_groups(minhash.groups(df, minhash.Settings(block=block)), rows, 5)


@pytest.mark.parametrize("two_blocks", [False, True])
def test_minhash_forest_of_one_large_bucket(spark, two_blocks):
    """A group around the threshold and one stranger in one bucket: fewer links than rows, the same components."""
    s = minhash.Settings()
    rows = varied(5, groups=1, copies=120) + [(900, prose(77, 200, 300))]
    sets = minhash.signatures(spark.createDataFrame(rows, "doc_id long, text string"), s).collect()
    texts = dict(rows)
    blocks = [int(two_blocks and r.id % 2) for r in sets]
    table = pa.table({
        "bucket": [7] * len(sets), "one": [0] * len(sets), "two": [int(two_blocks)] * len(sets), "block": blocks,
        "id": [r.id for r in sets], "component": [r.id for r in sets],
        "bands": pa.array([[7] * s.bands for _ in sets], pa.list_(pa.int64())),
        "signature": [bytes(r.signature) for r in sets], "text": [texts[r.id] for r in sets],
    })
    least = s.threshold / 100 - s.margin
    some = minhash._with_partner(least)(table)
    assert some.num_rows <= 120 and 900 not in some.column("id").to_pylist()
    found = minhash._forest(least, s.shingle, s.threshold)(table)
    links = list(zip(found.column("a").to_pylist(), found.column("b").to_pylist()))
    assert 0 < len(links) < len(rows)
    kept = [(i, t) for i, t in rows]
    good = [
        (a, b) for (a, x), (b, y) in combinations(kept, 2)
        if (not two_blocks or (a + b) % 2) and minhash.same_enough(x, y, 5, 80)
    ]
    assert len(good) > len(links)
    nodes = [i for i, _ in rows]
    assert least_reachable(nodes, links) == least_reachable(nodes, good)


def test_minhash_leaves_blocks_of_one_component_out(spark, monkeypatch):
    """A stranger in a large bucket is compared with every block; blocks of one component do not meet each other."""
    n, s = 200, minhash.Settings(block=10)
    ids = [(7, i, 10) for i in range(n)] + [(7, n, 10)]
    members = spark.createDataFrame(ids, "bucket long, id long, size long")
    labels = spark.createDataFrame([(i, 0) for i in range(n)], "id long, component long")
    classes = spark.createDataFrame(
        [(i, [7] * s.bands, bytearray(200)) for _, i, _ in ids], "id long, bands array<long>, signature binary"
    )
    texts = spark.createDataFrame([(i, "a b c d e f") for i in range(n)] + [(n, "q r s t u v")], "id long, text string")
    written = {}

    def noted(df, name):
        written[name] = df.persist()
        return df

    monkeypatch.setattr(minhash, "cut", noted)
    assert minhash.further_links(members, classes, labels, texts, s).count() == 0
    assert written["minhash-meet"].select("one", "two").distinct().count() <= -(-n // 10) + 1
    assert written["minhash-partners"].count() <= 2 * n + 40


def test_minhash_equal_keys_of_different_sets(spark):
    """Documents whose sets have equal keys but differ are told apart by their whole sets."""
    s = minhash.Settings()
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "p q r s t u v"), (4, "A  b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = minhash.signatures(docs, s).withColumn("key", F.lit(b"same"))
    got = {r.id: bytes(r.key) for r in minhash.told_apart(sets, docs.withColumnRenamed("doc_id", "id"), s).collect()}
    assert got[1] == got[2] == got[4] != got[3]


def test_minhash_odd(spark):
    docs = odd_docs(spark)
    check_groups(minhash.groups(docs), [(r[0], r[1]) for r in odd_rows()], 5)
    kept = minhash.dedup(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    want = brute_groups([(r[0], r[1]) for r in odd_rows()], 5)
    assert ids == sorted({i for i, c in want.items() if i == c})
    assert minhash.groups(empty_docs(spark)).count() == 0 and minhash.dedup(empty_docs(spark)).count() == 0


def brute_vectors(rows, threshold=0.93):
    def good(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    links = []
    usable = [(i, np.array(v, float), lab) for i, v, lab in rows if i is not None and lab is not None and good(v)]
    for (a, x, p), (b, y, q) in combinations(usable, 2):
        if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
            links.append((a, b))
    return links


def check_vectors(got, rows):
    links = brute_vectors(rows)
    want = least_reachable([r[0] for r in rows if r[0] is not None], links)
    count = {r[0]: 0 for r in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_links, r.component_id) == (count[r.vec_id], want.get(r.vec_id)), r
        assert r.kept == (r.vec_id == r.component_id)


VECTORS = "vec_id long, embedding array<float>, label int, n int, shard string"


def cloud(seed, n, groups, size, dims=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    for g in range(groups):
        base = rng.normal(size=dims)
        x[rng.choice(n, size, replace=False)] = base + rng.normal(size=(size, dims)) * rng.choice([0.02, 0.2, 0.3])
    return [(i, x[i].astype(np.float32).tolist(), int(i % 3), 0, "x") for i in range(n)]


def test_vectors_in_many_shards(spark):
    rows = cloud(1, 600, 12, 25)
    df = spark.createDataFrame(rows, VECTORS)
    got = vectors.near_duplicates(df, vectors.Settings(shard=60, recall=1.0, audit=600))
    check_vectors(got, [r[:3] for r in rows])


def dense_group(n, far, spread=0.12, dims=24):
    rng = np.random.default_rng(7)
    x = rng.normal(size=dims) + rng.normal(size=(n, dims)) * spread
    x = np.vstack([x, rng.normal(size=(far, dims))])
    return [(i, x[i].astype(np.float32).tolist(), 0, 0, "x") for i in rng.permutation(n + far).tolist()]


def test_vectors_dense_group_is_not_multiplied(spark):
    rows = dense_group(640, 200)
    s = vectors.Settings(shard=40, recall=1.0, audit=840)
    df = spark.createDataFrame(rows, VECTORS)
    classes = vectors._classes(df, "vec_id", "embedding", "label")[1]
    small, dense = vectors._shards(classes, s)
    assert small.count() + dense.count() < 5 * len(rows)
    assert max(r["count"] for r in small.groupBy("shard").count().collect()) <= 2 * s.shard
    assert dense.count() >= 640 and dense.agg({"blocks": "min"}).first()[0] > 1
    check_vectors(vectors.near_duplicates(df, s), [r[:3] for r in rows])


def test_vectors_one_dense_group(spark):
    rows = dense_group(500, 0, 0.25)
    s = vectors.Settings(shard=40, recall=1.0, audit=500)
    check_vectors(vectors.near_duplicates(spark.createDataFrame(rows, VECTORS), s), [r[:3] for r in rows])


def test_block_links_leave_pairs_of_earlier_shards():
    rng = np.random.default_rng(3)
    x = rng.normal(size=6) + rng.normal(size=(700, 6)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n, held = rng.integers(1, 4, 700), (rng.random((700, 2)) < 0.3).astype(float)
    near = (x @ x.T >= 0.93) & ~np.eye(700, dtype=bool)
    want = (near & (held @ held.T == 0)) @ n
    to_x, to_y, root = vectors.block_links(x, x, n, n, (held, held), 0.93, True)
    assert (to_x + to_y == want).all()
    a, b = slice(0, 300), slice(300, 700)
    mine = [vectors.block_links(x[p], x[p], n[p], n[p], (held[p], held[p]), 0.93, True) for p in (a, b)]
    cross_a, cross_b, _ = vectors.block_links(x[a], x[b], n[a], n[b], (held[a], held[b]), 0.93, False)
    assert (np.concatenate([mine[0][0] + mine[0][1] + cross_a, mine[1][0] + mine[1][1] + cross_b]) == want).all()
    assert (root == vectors._roots(700, np.argwhere(near))).all()


def test_recall_counts_vectors_of_small_groups(spark):
    expected = spark.createDataFrame([(i, 5000 if i < 3 else 1 if i < 6 else 0) for i in range(8)], "id long, expected long")
    links = spark.createDataFrame([(i, 5000 if i < 3 else 0) for i in range(8)], "id long, links long")
    assert vectors._recall(expected, links) == 0.5
    assert vectors._recall(expected.filter("expected = 0"), links) == 1


def test_audit_takes_groups_of_all_sizes(spark):
    rows = [(i, 900 if i < 2000 else 2 if i < 2010 else 0) for i in range(3000)]
    links = spark.createDataFrame(rows, "id long, links long")
    classes = links.selectExpr("id", "0 AS label", "array(1.0D) AS v")
    ids = [r.id for r in vectors._audited(classes, links, vectors.Settings(audit=60))]
    large, none = sum(i < 2000 for i in ids), sum(i >= 2010 for i in ids)
    assert set(range(2000, 2010)) <= set(ids) and 5 < large < 80 and 5 < none < 80
    assert len(vectors._audited(classes, links, vectors.Settings(audit=3000))) == 3000


def test_vectors_odd(spark):
    one = [1.0, 2.0, 2.0]
    rows = [
        (1, one, 0), (2, one, 0), (3, [2.0, 4.0, 4.0], 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 2.0], 0), (10, [1.0, float("nan"), 2.0], 0),
        (11, [float("inf"), 1.0, 1.0], 0), (12, [1.0, 2.0], 0), (13, [1.0, 2.0, 2.1], 0), (14, [-1.0, -2.0, -2.0], 0),
        (None, one, 0),
    ]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], VECTORS)
    got = vectors.near_duplicates(df)
    by_id = {r.vec_id: r for r in got.collect()}
    assert by_id[None].component_id is None and by_id[None].n_links == 0
    check_vectors(got, rows)
    assert vectors.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_graph_reaches_all():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(40, 8)) * 0.01 + rng.normal(size=8) for _ in range(9)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, start = vectors.robust_graph(x, vectors.Settings(near=5, far=0, degree=3))
    assert vectors._reached(graph, start).all()
