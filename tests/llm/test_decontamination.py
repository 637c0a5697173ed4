"""FM-index and benchmark decontamination against brute force."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import empty_docs, odd_docs, odd_rows, prose
from pyspark.sql import functions as F

from basinflow.llm import decontamination as dec
from basinflow.llm import fmindex
from basinflow.llm.terms import TABLE, packed_words, tokenise, unpacked_words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, extra string"


def terms(text):
    return TERM.findall((text or "").translate(LOWERED))


def brute(docs, items, window=10):
    wanted = {}
    for number, text, *_ in items:
        ws = terms(text)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            wanted.setdefault(tuple(ws[i : i + window]), set()).add("" if number is None else str(number))
    sizes = {len(w) for w in wanted}
    out = []
    for number, text, *_ in docs:
        ws = terms(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(ws) - k + 1):
                if (w := tuple(ws[i : i + k])) in wanted:
                    hit.update(range(i, i + k))
                    found |= wanted[w]
        out.append((str(number), len(ws), len(hit), sorted(found)))
    return sorted(out)


def told(df):
    return sorted((str(r.id), r.n_words, r.n_hit, r["items"]) for r in df.collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=15), min_size=1, max_size=5), st.lists(
    st.lists(st.integers(1, 4), min_size=2, max_size=2), min_size=1, max_size=6))
def test_index_finds_every_occurrence(texts, patterns):
    symbols = np.array([x for t in texts for x in [*t, 0]], np.int32)
    wanted = np.array(patterns)
    wanted[wanted > symbols.max()] = -1
    index = fmindex.Index(fmindex.build(symbols, 4))
    for pattern, low, high in zip(wanted, *index.search(wanted)):
        want = [i for i in range(len(symbols) - 1) if (symbols[i : i + 2] == pattern).all()]
        assert sorted(index.locate(np.arange(low, high)).tolist()) == want


@pytest.mark.parametrize("n", [1, 2, 50, 3_000])
def test_suffixes_in_order(n):
    symbols = np.array([*([1] * n), 0, *([1, 2] * (n // 2)), 0, 0], np.int32)
    ends = {p: i for i, p in enumerate(np.flatnonzero(symbols == 0).tolist())}

    def suffix(at):
        end = next(p for p in sorted(ends) if p >= at)
        return [*((1, x) for x in symbols[at:end].tolist()), (0, ends[end])]

    got = fmindex.suffix_array(symbols).tolist()
    assert sorted(got) == list(range(len(symbols)))
    some = got if n < 100 else got[:: len(got) // 50]
    assert [suffix(a) for a in some] == sorted(suffix(a) for a in some)


@settings(deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_terms_of_texts(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    found = tokenise([t.encode().translate(TABLE) for t in texts])
    words = unpacked_words(packed_words(found.words)).to_pylist() if len(found.words) else []
    flat = iter(found.codes.tolist())
    assert [[words[next(flat)] for _ in range(n)] for n in found.counts.tolist()] == [terms(t) for t in texts]


def planted():
    base = prose(5, 40)
    items = [
        (1, prose(6, 25), "x"), (2, prose(7, 10), "x"), (3, "Only Four short, words!", "x"), (4, None, "x"),
        (5, " ,;! ", "x"), (6, prose(6, 25), "x"), (None, prose(8, 12), "x"), (1, prose(9, 11), "x"),
        (7, "rho rho rho rho rho rho rho rho rho rho rho", "x"),
    ]
    docs = [
        (100, base, None, None, 0), (101, f"{base} {prose(6, 25)} {base}", None, None, 0),
        (102, prose(7, 10).upper().replace(" ", "--"), None, None, 0),
        (103, f"so: only four SHORT words. {prose(8, 12)}", None, None, 0), (104, "rho " * 300, None, None, 0),
        (105, " ".join(prose(6, 25).split()[2:13]) + " x " + prose(9, 11), None, None, 0),
        (105, " ".join(prose(6, 25).split()[2:13]) + " x " + prose(9, 11), None, None, 0),
        (None, prose(7, 10), None, None, 0), (106, f"{prose(11, 4_000)} {prose(6, 25)} {prose(12, 3_000)}", None, None, 0),
    ]
    return items, docs


@pytest.mark.parametrize("form", [dec.Settings(), dec.Settings(shard_bytes=700, block_windows=7, rate=3)])
def test_report_equals_brute_force(spark, form):
    items, docs = planted()
    docs = docs + odd_rows()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("id", "row", "spans", "items", "digest"):
        frame = frame.withColumn(name, F.lit(name))
    want = brute(docs, items)
    got = told(dec.report(frame, spark.createDataFrame(items, ITEMS), form))
    assert got == want
    assert {w[2] for w in want} > {0, 10, 16, 25, 300}


def test_other_windows(spark):
    items, docs = planted()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    for window in (1, 4):
        form = dec.Settings(window=window, shard_bytes=2_000)
        assert told(dec.report(frame, spark.createDataFrame(items, ITEMS), form)) == brute(docs, items, window)


def test_clean_cuts_spans_only(spark):
    items, docs = planted()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame = frame.withColumns({"spans": F.lit(1), "number": F.lit(2), "digest": F.lit(3)})
    out = dec.clean(frame, spark.createDataFrame(items, ITEMS))
    assert out.columns == frame.columns and out.count() == len(docs)
    left = {(r.doc_id, r.text) for r in out.collect()}
    base = prose(5, 40)
    assert (100, base) in left and (101, f"{base}  {base}") in left and (102, "") in left and (104, " ") in left
    assert (103, "so: ") in left and (105, " x ") in left and (None, "") in left
    assert all(not n for _, _, n, _ in brute([(d, t) for d, t in left], items))


def test_no_rows(spark):
    items = spark.createDataFrame([], ITEMS)
    docs = odd_docs(spark)
    assert {(r.n_hit, tuple(r["items"])) for r in dec.report(docs, items).collect()} == {(0, ())}
    assert dec.report(docs, items).count() == docs.count()
    some = spark.createDataFrame(planted()[0], ITEMS)
    assert dec.report(empty_docs(spark), some).count() == 0
    assert dec.clean(docs, items).count() == docs.count()
