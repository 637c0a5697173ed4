"""Exact dedup, mixing and chat formatting."""

import hashlib
import re
from collections import defaultdict

import pytest
from odd import empty_docs, odd_docs, odd_rows
from support import plan_of

from basinflow.llm import chat, exact, mixing

PYTHON = re.compile("EvalPython|InPandas|InArrow")


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_marks(spark):
    docs = odd_docs(spark)
    got = exact.mark(docs)
    groups = defaultdict(list)
    for r in odd_rows():
        groups[squeeze(r[1])].append(r[0])
    found = got.collect()
    assert len(found) == len(odd_rows())
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_digest[r.text_sha256]
        least = min((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (least, len(ids), r.doc_id == least)
    assert not PYTHON.search(plan_of(got))


def test_exact_dedup_keeps_one_row_and_all_columns(spark):
    docs = odd_docs(spark)
    got = exact.dedup(docs)
    assert got.columns == docs.columns
    texts = [squeeze(r.text) for r in got.collect()]
    assert sorted(texts) == sorted({squeeze(r[1]) for r in odd_rows()})


def test_exact_hot_group_is_combined_before_it_meets(spark):
    docs = spark.range(0, 5000, 1, 8).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', 'text ' || id) AS text")
    got = exact.mark(docs).filter("text_sha256 = sha2('same text', 256)").collect()
    assert len(got) == 1667 and {(r.keep_id, r.group_size) for r in got} == {(0, 1667)}


@pytest.mark.parametrize("fn", [exact.mark, exact.dedup, mixing.plan, mixing.mix])
def test_no_rows(spark, fn):
    assert fn(empty_docs(spark)).count() == 0


def level(sizes, weights, cap=3):
    """Targets by sharing again until nothing is above its cap."""
    total, done = sum(sizes), {}
    while True:
        left = [i for i in range(len(sizes)) if i not in done]
        rest = total - sum(done.values())
        shares = {i: rest * weights[i] / sum(weights[j] for j in left) for i in left}
        over = [i for i in left if shares[i] > cap * sizes[i]]
        if not over:
            return [done.get(i, shares.get(i)) for i in range(len(sizes))]
        done |= {i: cap * sizes[i] for i in over}


@pytest.mark.parametrize("sizes", [[100, 10, 1, 1000], [5, 5, 5], [1, 0, 7], [1000, 1, 1, 1, 1, 1], [3]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = level(sizes, [i % 3 + 1 for i in range(len(sizes))])
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(want)


def test_mix_is_near_targets_and_repeats(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = mixing.plan(docs)
    assert not PYTHON.search(plan_of(plan))
    rows = plan.select("id", "source", "size", "source_size", "target", "copies").collect()
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 3
    for r in rows:
        most = max(x.size for x in rows if x.source == r.source)
        assert abs(taken[r.source] - r.target) <= 2 * most
    again = mixing.plan(docs.repartition(3)).select("id", "source", "size", "source_size", "target", "copies").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_odd(spark):
    docs = odd_docs(spark)
    assert mixing.plan(docs).count() == docs.count()
    assert mixing.mix(docs).columns == docs.columns
    nulls = [r for r in mixing.plan(docs).collect() if r.source is None]
    assert len(nulls) == 3 and all(r.target == nulls[0].target for r in nulls)


TURNS = "conv_id long, turn long, role string, text string, part string, n_turns int"


def chats(spark, convs, **kw):
    rows = [(c, i, r, t, "x", 0) for c, turns in convs for i, (r, t) in enumerate(turns)]
    return chat.render(spark.createDataFrame(rows, TURNS), **kw)


def test_chat_drops_snapshots(spark):
    a, b, c = ("user", "hi"), ("assistant", "ho"), ("user", "more")
    convs = [(1, [a]), (2, [a, b]), (3, [a, b, c]), (4, [a, c]), (5, [a, b, c]), (6, [b]), (None, [c]),
             (7, [("user", None)]), (8, [("user", "")]), (9, [(None, "hi"), b])]
    got = {r.conv_id: r for r in chats(spark, convs).collect()}
    assert set(got) == {3, 4, 6, None, 7, 8, 9}
    assert got[3].n_copies == 2 and got[3].n_turns == 3
    assert got[4].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    assert got[9].text.startswith("<|im_start|>unknown\nhi")


def test_chat_blocks_and_repeated_turns(spark):
    long = [("user", f"t{i}") for i in range(300)]
    rows = [(1, i, *t, "x", 0) for i, t in enumerate(long)] + [(2, i, *t, "x", 0) for i, t in enumerate(long[:200])]
    rows += [(3, 0, "user", "same", "x", 0)] * 2 + [(4, None, "user", "first", "x", 0), (4, 1, "user", "z", "x", 0)]
    got = chat.render(spark.createDataFrame(rows, TURNS), block=64).orderBy("conv_id", "part").collect()
    assert [(r.conv_id, r.part) for r in got] == [(1, i) for i in range(5)] + [(3, 0), (4, None), (4, 0)]
    assert "".join(r.text for r in got if r.conv_id == 1).count("<|im_start|>") == 300
    assert got[5].n_turns == 2
    assert not PYTHON.search(plan_of(chat.render(spark.createDataFrame(rows, TURNS))))


def test_chat_blocks_by_place_where_turn_numbers_repeat(spark):
    rows = [(None, i % 5, "user", f"t{i * 7 % 401}", "x", 0) for i in range(1200)]
    rows += [(None, None, "user", f"n{i}", "x", 0) for i in range(150)] + [(1, 3, "user", "same", "x", 0)] * 300
    rows += [(2, 3, "user", "same", "x", 0)] * 100 + [(3, 3, "user", "same", "x", 0)] * 100 + [(3, 4, None, "z", "x", 0)]
    rows += [(4, 10**6 * i, "user", f"g{i}", "x", 0) for i in range(3)] + [(5, None, "user", f"n{i}", "x", 0) for i in range(64)]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = chat.render(df, block=64).orderBy("conv_id", "part").collect()
    assert {r.conv_id for r in got} == {None, 1, 3, 4, 5}
    for conv in (None, 1, 3, 4, 5):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3]))
        parts = [r for r in got if r.conv_id == conv]
        assert "".join(r.text for r in parts) == "".join(
            f"<|im_start|>{r[2] or 'unknown'}\n{r[3]}<|im_end|>\n" for r in mine)
        assert {(r.n_turns, r.n_copies) for r in parts} == {(len(mine), 1)}
        assert max(r.text.count("<|im_start|>") for r in parts) <= 64
    assert [r.part for r in got if r.conv_id is None] == [None, -2, -1, *range(19)]
    assert [r.part for r in got if r.conv_id == 4] == [0]


def test_chat_no_rows(spark):
    assert chat.render(spark.createDataFrame([], TURNS)).count() == 0
