"""Cross-tokenizer alignment against the libraries and a plain count."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import empty_docs, odd_docs, odd_rows, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basinflow.llm import alignment, mphash
from basinflow.llm.queries import piece_vocabulary, vocabulary

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
A = Tokenizer.from_file(vocabulary())
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary())
OWN = alignment.Tokenizers(*(open(p, "rb").read() for p in (vocabulary(), piece_vocabulary())))
CHARS = {c: bytes([b]) for c, b in alignment._byte_chars().items()}


def piece(i):
    text = B.id_to_piece(i)
    return bytes([int(text[3:5], 16)]) if B.is_byte(i) else text.replace("▁", " ").encode()


def plain(text):
    """Token ids with the ends of their bytes, or None without tokens."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a = [b"".join(CHARS[c] for c in A.id_to_token(i)) for i in a]
    bytes_b = [piece(i) for i in b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    return [list(zip(ids, np.cumsum(list(map(len, held))).tolist())) for ids, held in ((a, bytes_a), (b, bytes_b))]


def links(sides):
    out = []
    a, b = sides
    i = j = 0
    while i < len(a) and j < len(b):
        out.append((a[i][0], b[j][0]))
        end = min(a[i][1], b[j][1])
        i, j = i + (a[i][1] == end), j + (b[j][1] == end)
    return out


def groups(sides):
    ends = sorted({e for _, e in sides[0]} & {e for _, e in sides[1]})
    out, at = [], [0, 0]
    for end in ends:
        held = []
        for k, side in enumerate(sides):
            first = at[k]
            while at[k] < len(side) and side[at[k]][1] <= end:
                at[k] += 1
            held.append(",".join(str(i) for i, _ in side[first : at[k]]))
        out.append("|".join(held))
    return out


def brute(docs):
    held = [(number, plain(text)) for number, text, *_ in docs]
    counts = Counter(p for _, x in held if x for p in set(links(x)))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for number, x in held:
        if x is None:
            out.append((str(number), 0, 0, 0, 0, 0, 0, ""))
            continue
        found, cut = links(x), groups(x)
        out.append((
            str(number), len(x[0]), len(x[1]), len(cut), len(found), sum(counts[p] == most[p[0]] for p in found),
            sum(counts[p] for p in found), hashlib.sha256(";".join(cut).encode()).hexdigest(),
        ))
    return sorted(out), counts, most


def told(df):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r.id), *(r[n] for n in names)) for r in df.collect())


def chunk_equals(texts):
    chunk = alignment.Chunk(texts, OWN)
    want = [plain(t) for t in texts]
    x = chunk.aligned
    assert list(chunk.groups()) == [";".join(groups(w)) if w else "" for w in want]
    for values, count in ((x.n_a, lambda w: len(w[0])), (x.n_b, lambda w: len(w[1])), (x.n_links, lambda w: len(links(w)))):
        assert chunk.per_doc(values).tolist() == [count(w) if w else 0 for w in want]
    counts = Counter(p for w in want if w for p in set(links(w)))
    pairs, n = chunk.pair_counts()
    assert {(p >> 32, p & 0xFFFFFFFF): c for p, c in zip(pairs.tolist(), n.tolist())} == counts


TEXTS = st.text(max_size=40).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t))


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_any_text(texts):
    chunk_equals(texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([
    " ", "  ", "\n", "\t", "\x1c", "\xa0", " ", "　", "▁", "​", "\x00", "'s", "'LL", "the", " of", "1", "½", "é",
    "é", "漢", "😀", "<|endoftext|>", "</s>", "<unk>", "<0x41>", ".", "word", "ﬁ",
]), max_size=25).map("".join), min_size=1, max_size=3))
def test_edges(texts):
    chunk_equals(texts)


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**62, n))
    number = mphash.Function(mphash.build(keys))
    assert number.n == len(keys)
    assert sorted(number(keys).tolist()) == list(range(len(keys)))
    other = rng.integers(0, 2**62, 50)
    assert (number(other) < max(1, number.n)).all()


def test_perfect_hash_lists_the_rest(monkeypatch):
    monkeypatch.setattr(mphash, "LEVELS", 1)
    keys = np.arange(5_000) << 32 | 7
    made = mphash.build(keys)
    number = mphash.Function(made)
    assert len(made["rest"]) and sorted(number(keys).tolist()) == list(range(5_000))
    assert (number(np.array([-5, 2**61])) < 5_000).all()


@pytest.mark.parametrize("form", [alignment.Settings(), alignment.Settings(chunk_bytes=30_000, fan=2)])
def test_documents_equal_brute_force(spark, form):
    docs = odd_rows() + [(20 + i, prose(i, 30 + i), None, None, 0) for i in range(30)] + [(70, "a▁b", None, None, 0)]
    frame = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(c) for c in ("id", "leaf", "ids", "texts", "told")})
    got = alignment.per_document(frame, vocabulary(), piece_vocabulary(), form)
    want, counts, most = brute(docs)
    assert told(got) == want
    assert ("70", 0, 0, 0, 0, 0, 0, "") in want
    table = alignment.pair_table(frame, vocabulary(), piece_vocabulary(), form)
    assert {(r.a, r.b): (r["count"], r.best) for r in table.collect()} == {
        p: (n, n == most[p[0]]) for p, n in counts.items()
    }


def test_groups_as_text(spark):
    docs = [(1, "Hello there", None, None, 0), (2, None, None, None, 0)]
    out = alignment.per_document(
        spark.createDataFrame(docs, DOCS), vocabulary(), piece_vocabulary(), with_groups=True
    ).orderBy("id").collect()
    assert out[0].groups == ";".join(groups(plain("Hello there"))) and out[1].groups == ""


def test_no_rows(spark):
    assert alignment.per_document(empty_docs(spark), vocabulary(), piece_vocabulary()).count() == 0
    blank = odd_docs(spark).withColumn("text", F.lit(None).cast("string"))
    assert {r.n_links for r in alignment.per_document(blank, vocabulary(), piece_vocabulary()).collect()} == {0}


def test_stored_rows_hold_one_document(spark):
    """A task's share of chunks must not become a few rows, which Parquet would put into one page."""
    docs = [(i, "é漢😀 " * 40 + str(i), None, None, 0) for i in range(90)] + [(None, None, None, None, 0)]
    frame = spark.createDataFrame(docs, DOCS).coalesce(1)
    packs = alignment._packs(frame, alignment.Settings(chunk_bytes=2_000), "doc_id", "text")
    stored = packs.collect()
    assert sorted((r.id is None, r.id, r.text) for r in stored) == sorted((d[0] is None, d[0], d[1]) for d in docs)
    held = Counter()
    for r in stored:
        held[r.leaf] += len((r.text or "").encode())
    assert len(held) > 10 and max(held.values()) <= 2_000 + 500


def test_chunks_read_in_pieces(spark, monkeypatch):
    """Rows of one chunk may come to several tasks, or not next to each other."""
    kept = alignment._packs
    monkeypatch.setattr(alignment, "_packs", lambda *a: kept(*a).repartition(7))
    docs = [(20 + i, prose(i, 30 + i), None, None, 0) for i in range(30)] + [(70, None, None, None, 0)]
    got = alignment.per_document(
        spark.createDataFrame(docs, DOCS).coalesce(1), vocabulary(), piece_vocabulary(), alignment.Settings(chunk_bytes=900)
    )
    assert told(got) == brute(docs)[0]


def test_runs_of_chunks():
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(t, pa.string())], ["leaf", "text"]) for x, t in (
        ([], []), ([5, 5, 7], ["a", None, "b"]), ([7, 5], ["c", "d"]), ([], []), ([5], ["e"]),
    )]
    assert list(alignment._chunks(batches)) == [(5, ["a", None]), (7, ["b", "c"]), (5, ["d", "e"])]
    assert list(alignment._chunks([])) == []
