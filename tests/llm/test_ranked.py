"""Posting lists and ranked search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd import empty_docs, odd_docs, odd_rows, prose
from pyspark.sql import functions as F

from basinflow.llm import postings, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, extra string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def terms(text):
    return TERM.findall((text or "").translate(LOWERED))


def brute(docs, items, k=50):
    tfs = [(number, Counter(terms(text))) for number, text, *_ in docs]
    n = sum(bool(c) for _, c in tfs)
    total = sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    queries = defaultdict(set)
    for number, text, *_ in items:
        queries[number] |= set(terms(text))
    out = []
    for item, wanted in queries.items():
        scored = []
        for number, c in tfs:
            score = 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 50 + 50 * c.total() * n // total
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, number is None, number or 0, number))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("item", "rank", "doc", "score").collect()), key=str)


@pytest.mark.parametrize("seed", range(5))
def test_lists_come_back(seed):
    rng = np.random.default_rng(seed)
    n_docs, n_words = 3_000, 40
    lengths = rng.integers(1, 90_000, n_docs)
    rows = {}
    for t in range(n_words):
        for d in rng.choice(n_docs, int(rng.integers(0, 900)) if t % 3 else 1, replace=False).tolist():
            rows[(t, d)] = int(rng.choice([1, 1, 1, 2, 3, 4, 9, 300, 70_000]))
    keys = sorted(rows)
    made = postings.build(
        np.array([t for t, _ in keys]), np.array([d for _, d in keys]), np.array([rows[k] for k in keys]), lengths, n_words
    )

    def part(tf, length):
        return 10**9 * tf // (1000 * tf + 20 * (50 + length // 100))

    lists = postings.Lists(made, lengths, part)
    for t in range(n_words):
        a, b = lists.blocks(t)
        want = [(d, int(part(rows[(t, d)], lengths[d]))) for u, d in keys if u == t]
        if not want:
            assert a == b
            continue
        docs, parts = lists.some(range(a, b))
        assert list(zip(docs.tolist(), parts.tolist())) == want
        for block, bound in zip(range(a, b), lists.bounds(np.arange(a, b)).tolist()):
            assert lists.block(block)[1].max() <= bound
            assert lists.firsts[block] == lists.block(block)[0][0] and lists.lasts[block] == lists.block(block)[0][-1]


def test_blocks_are_skipped_and_nothing_is_lost():
    rng = np.random.default_rng(1)
    n_docs = 20_000
    lengths = np.sort(rng.integers(20, 4_000, n_docs))
    rows = {}
    for t, share in enumerate((0.9, 0.6, 0.02, 0.004)):
        for d in np.flatnonzero(rng.random(n_docs) < share).tolist():
            rows[(t, d)] = int(rng.integers(1, 6))
    keys = sorted(rows)
    made = postings.build(*(np.array(x) for x in zip(*((t, d, rows[(t, d)]) for t, d in keys))), lengths, 4)
    weights = np.array([30, 300, 3_000, 5_000])

    def part(tf, length):
        return 10**9 * tf // (1000 * tf + 20 * (50 + 50 * length // 2_000))

    lists = postings.Lists(made, lengths, part)
    docs, scores = ranked.search(lists, np.arange(4), weights, 50, 1)
    want = np.zeros(n_docs, np.int64)
    for (t, d), tf in rows.items():
        want[d] += weights[t] * part(tf, lengths[d])
    best = np.lexsort((np.arange(n_docs), -want))[:50]
    found = dict(zip(docs.tolist(), scores.tolist()))
    assert [found[d] for d in best.tolist()] == want[best].tolist()
    assert lists.unpacked < 0.5 * len(lists.sizes)


def corpus(seed, n):
    rng = random.Random(seed)
    stock = [prose(i, 1) + str(i % 7) for i in range(60)]
    return [
        (i if i % 11 else None, " ".join(rng.choice(stock[: rng.randrange(1, 60)]) for _ in range(rng.randrange(0, 60))),
         None, None, 0)
        for i in range(n)
    ]


@pytest.mark.parametrize("form", [ranked.Settings(), ranked.Settings(k=3, shard_bytes=1_500, block_terms=20, task_queries=2)])
def test_best_equals_brute_force(spark, form):
    docs = corpus(3, 300) + odd_rows()
    items = [(i, docs[7 * i][1], "x") for i in range(12)] + [
        (3, "more of Three: ONE two", "x"), (None, docs[5][1], "x"), (90, None, "x"), (91, " ,; ", "x"), (92, "nowhere", "x"),
        (93, "one", "x"),
    ]
    frame = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(c) for c in ("id", "rank", "score", "doc", "item")})
    got = told(ranked.best(frame, spark.createDataFrame(items, ITEMS), form))
    assert got == brute(docs, items, form.k)
    assert {r[0] for r in got} == {*range(12), None, 93}


def test_ties_stand_by_id(spark):
    docs = [(i, "same words here", None, None, 0) for i in (9, 3, 7, 3, 1)] + [(None, "same words here", None, None, 0)]
    docs += [(50 + i, f"other {i}", None, None, 0) for i in range(20)]
    out = ranked.best(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, "words", "")], ITEMS),
                      ranked.Settings(k=4, shard_bytes=100))
    assert [r.doc for r in out.orderBy("rank").collect()] == [1, 3, 3, 7]


def test_no_rows(spark):
    items = spark.createDataFrame([(1, "one two", "")], ITEMS)
    assert ranked.best(empty_docs(spark), items).count() == 0
    assert ranked.best(odd_docs(spark), spark.createDataFrame([], ITEMS)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, 0), (2, " ", None, None, 0)], DOCS)
    assert ranked.best(blank, items).count() == 0
