"""BPE against the tokenizers library."""

import random
import sys

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import empty_docs, odd_docs, odd_rows
from tokenizers import Tokenizer as Reference

from basinflow.llm import bpe
from basinflow.llm.queries import vocabulary

REF = Reference.from_file(vocabulary())
OWN = bpe.Tokenizer(open(vocabulary(), encoding="utf-8").read())


def own_ids(text):
    return [i for groups in OWN.encode([text]) for piece in groups for i in piece]


def same(text):
    want = REF.encode(text, add_special_tokens=False).ids
    assert own_ids(text) == want
    assert OWN.decode(want) == REF.decode(want, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(
    [" ", "  ", "\n", "\x1c", " ", "'s", "'LL", "the", " of", "1", "½", "é", "漢", "😀", "<|endoftext|>", "<|", "​"]
), max_size=40).map("".join))
def test_edges(text):
    same(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_256), max_size=60))
def test_decode_any_ids(ids):
    assert OWN.decode(ids) == REF.decode(ids, skip_special_tokens=False)


def test_long_pieces_and_forgetting(monkeypatch):
    rng = random.Random(0)
    for text in ("a" * 30_000, "ab" * 9_000, " " * 9_000 + "x", "".join(rng.choice("abcde") for _ in range(20_000))):
        same(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "LONG_TEXT", 200)
    for n in (50, 150, 400):
        same(" ".join("".join(rng.choice("theandofr") for _ in range(rng.randrange(1, 90))) for _ in range(n)))
    texts = ["one two", "three " * 100, "four five", "<|endoftext|>", ""]
    got = [[i for piece in groups for i in piece] for groups in OWN.encode(texts)]
    assert got == [REF.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_outside_are_skipped():
    assert OWN.decode([-1, 15496, 10**6]) == "Hello"


def test_frames(spark):
    docs = odd_docs(spark)
    tokens = bpe.encode(docs, vocabulary())
    texts = bpe.decode(tokens, vocabulary())
    want = sorted((str(r[0]), r[1] or "") for r in odd_rows())
    assert sorted((str(r.doc_id), r.text) for r in texts.collect()) == want
    ids = sorted((str(r.doc_id), r.ids) for r in tokens.collect())
    assert ids == sorted((str(r[0]), REF.encode(r[1] or "", add_special_tokens=False).ids) for r in odd_rows())


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [15496, None])], "doc_id long, ids array<int>")
    assert [tuple(r) for r in bpe.decode(df, vocabulary()).orderBy("doc_id").collect()] == [(1, None), (2, ""), (3, "Hello")]
    assert bpe.encode(empty_docs(spark), vocabulary()).count() == 0


def test_other_files_are_refused(tmp_path, spark):
    path = tmp_path / "v.json"
    path.write_text('{"model": {"type": "WordPiece"}, "pre_tokenizer": {"type": "ByteLevel"}}')
    with pytest.raises(ValueError):
        bpe.encode(empty_docs(spark), str(path))


def test_lists_are_gathered_at_once():
    """Ids and texts of many rows come from arrays: the calls of Python code do not grow with the ids."""
    texts = ["the cat's 12 hats \u00e9t\u00e9 " * n for n in (0, 1, 300, 2)]
    flat, ends = OWN.encode_flat(texts)
    want = [REF.encode(t, add_special_tokens=False).ids for t in texts]
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        OWN.encode_flat(texts)
        OWN.decode_lists(pa.array(want, pa.list_(pa.int32())))
    finally:
        sys.setprofile(None)
    assert sum(map(len, want)) > 2_000 > len(calls)


def test_lists_with_odd_ids():
    half = REF.encode("\u6f22", add_special_tokens=False).ids
    rows = [None, [], [15496, -1, 10**6, None], half[:1], half[1:], half, [15496]]
    lists = pa.array([[1, 2], *rows], pa.list_(pa.int32()))[1:]
    want = [None if r is None else REF.decode([i for i in r if i in range(50_257)], skip_special_tokens=False) for r in
            [None if r is None else [i for i in r if i is not None] for r in rows]]
    assert OWN.decode_lists(lists).to_pylist() == want


@pytest.mark.parametrize("limit", [1 << 7, 1 << 16])
def test_plain_pattern(limit):
    rng = random.Random(limit)
    plain = bpe._plain_pattern(limit)
    every = [chr(c) for c in range(limit) if not 0xD800 <= c < 0xE000]
    rng.shuffle(every)
    texts = ["".join(every), " ".join(every), "a".join(every)]
    few = ["'", "s", "ll", " ", "  ", "\n", "\x1c", "\x1f", "1", "x", "!", *[c for c in "\u00a0\u00bd\u00e9\u2028\u3000" if ord(c) < limit]]
    texts += ["".join(rng.choices(few, k=40)) for _ in range(2_000)]
    assert all(plain.findall(t) == OWN.pattern.findall(t) for t in texts)
