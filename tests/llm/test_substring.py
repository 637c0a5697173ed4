"""Substring dedup against brute force."""

import hashlib
import random
import sys

import pytest
from odd import empty_docs, odd_docs, odd_rows, prose
from pyspark.sql import functions as F

from basinflow.llm import substring


def brute(rows, window):
    """Words left and words lost per row, by definition; a null id is larger than all others."""
    number = [2**63 if i is None else i for i, _ in rows]
    words = [[w for w in (t or "").encode().split()] for _, t in rows]
    least = {}
    for i, ws in zip(number, words):
        for p in range(len(ws) - window + 1):
            key = tuple(ws[p : p + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, ws in zip(number, words):
        gone = set()
        for p in range(len(ws) - window + 1):
            if least[tuple(ws[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((len(ws), len(gone), b" ".join(w for p, w in enumerate(ws) if p not in gone).decode()))
    return out


def check(spark, rows, docs=None, settings=substring.Settings()):
    docs = docs or spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, settings.window)
    texts = substring.dedup(docs, settings)
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    got = sorted(((r.doc_id, r.text) for r in texts.collect()), key=key)
    assert got == sorted(((i, w[2]) for (i, _), w in zip(rows, want)), key=key)
    left = substring.left_of_texts(docs, settings)
    counts = substring.per_document(docs, left, settings).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed) for r in counts), key=key) == sorted(
        ((i, w[0], w[1]) for (i, _), w in zip(rows, want)), key=key
    )


def corpus(seed, n=60):
    rng = random.Random(seed)
    passages = [prose(1000 * seed + i, rng.randrange(12, 70), 200) for i in range(5)]
    rows = []
    for i in range(n):
        parts = [prose(seed * 77 + i, rng.randrange(0, 60), 200)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), prose(seed * 99 + i, rng.randrange(0, 30), 200)]
        text = rng.choice([" ", "\n", " \t"]).join(parts)
        rows.append((i, rows[rng.randrange(i)][1] if i and rng.random() < 0.15 else text))
    rng.shuffle(rows)
    return rows


SMALL = substring.Settings(part_words=500, group_words=50, task_anchors=300, task_suffixes=200, sample_docs=20)


@pytest.mark.parametrize("seed, settings", [(1, substring.Settings()), (2, SMALL), (3, SMALL)])
def test_against_brute_force(spark, seed, settings):
    check(spark, corpus(seed), settings=settings)


def test_one_word_texts_and_few_words(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    rows += [(100, "w " * 500), (101, "w " * 40), (102, "w " * 12)]
    check(spark, rows, settings=SMALL)


def test_odd_rows(spark):
    check(spark, [(r[0], r[1]) for r in odd_rows()], odd_docs(spark))


def test_no_rows(spark):
    assert substring.dedup(empty_docs(spark)).count() == 0


def test_hot_passage(spark):
    passage = prose(9, 60)
    docs = spark.range(0, 3000, 1, 8).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("start "), F.sha2(F.col("id").cast("string"), 256), F.lit(" " + passage)).alias("text")
    )
    left = substring.left_of_texts(docs)
    got = substring.per_document(docs, left).groupBy("n_removed").count().collect()
    assert {(r.n_removed, r["count"]) for r in got} == {(0, 1), (60, 2999)}


def test_prefixes_cover_every_suffix_alike():
    suffixes = [prose(i, 13, 20).encode().split() for i in range(400)] + [[b"x"] * 13] * 200
    prefixes = substring.Prefixes(suffixes, 40)
    sizes = {}
    for s in suffixes:
        g = prefixes.group(b" ".join(s))
        sizes[g] = sizes.get(g, 0) + 1
    assert 20 < len(sizes) <= 40 and max(sizes.values()) <= 230
    assert prefixes.group(b"never seen before") == prefixes.group(b"never seen before")


def test_digests(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.digest for r in substring.per_document(docs, substring.left_of_texts(docs)).collect()}
    for i, text in rows:
        assert found[i] == hashlib.sha256(b" ".join(text.encode().split())).hexdigest()


@pytest.mark.parametrize("span", [1 << 20, 1_000])
def test_words_are_hashed_from_bytes(monkeypatch, span):
    """Equal words have equal hashes wherever they stand, other words other ones; no call is made per word."""
    monkeypatch.setattr(substring, "SPAN", span)
    rng = random.Random(3)
    words = list({bytes(rng.choices(b"ab\xc3\xa4z", k=rng.randrange(1, 12))) for _ in range(20_000)})
    words += [b"x" * n for n in (1_023, 1_024, 1_025, 5_000)]
    shuffled = rng.sample(words, len(words))
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        one, two = (substring._word_hashes(b" ".join(x)) for x in (words, shuffled))
    finally:
        sys.setprofile(None)
    assert dict(zip(words, one.tolist())) == dict(zip(shuffled, two.tolist()))
    assert len(set(one.tolist())) == len(words)
    assert span < 1 << 20 or len(calls) < 1_000


def test_equal_windows_name_equal_anchors():
    s = substring.Settings()
    passage = prose(5, 40, 200).encode().split()
    runs = []
    for front in (prose(6, 30, 200), prose(7, 11, 200)):
        words = front.encode().split() + passage
        places, _ = substring.anchors(b" ".join(words), s)
        begin = len(words) - len(passage)
        assert (places[1:] > places[:-1]).all()
        runs.append({tuple(words[p : p + s.anchor]) for p in places if p >= begin + s.window - s.anchor})
        assert all(any(w <= p <= w + s.window - s.anchor for p in places) for w in range(len(words) - s.window + 1))
    assert runs[0] == runs[1] and runs[0]
