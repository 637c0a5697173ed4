"""Each stage on its predecessor's rows, and the registered queries next to their SQL."""

import re
from collections import Counter

import pytest
from odd import empty_docs, odd_docs
from test_similar import brute_groups
from tokenizers import Tokenizer as Reference

import corpus_pipeline as pipeline
from basinflow.llm import mixing, quality
from basinflow.llm.queries import ORACLE, QUERIES, held_out, vocabulary
from tools.check import compare, connect


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], sf).cache())
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_quality_stage(spark, sf, stages):
    docs, kept = stages[0], stages[1]
    model = quality.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~held_out())
    good = {r.doc_id for r in quality.score(docs, model).filter("predicted = 1").collect()}
    assert rows(kept) == Counter({r: n for r, n in rows(docs).items() if r[0] in good})
    assert 0 < len(good)


def test_exact_stage(stages):
    least = {}
    for r in stages[1].collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text)
        if key not in least or r.doc_id < least[key].doc_id:
            least[key] = r
    assert rows(stages[2]) == Counter(map(tuple, least.values()))


def test_near_stage(stages):
    before = stages[2].collect()
    groups = brute_groups([(r.doc_id, r.text) for r in before], 5)
    assert rows(stages[3]) == Counter(tuple(r) for r in before if groups[r.doc_id] == r.doc_id)


def test_mixing_stage(stages):
    copies = {r.id: r.copies for r in mixing.plan(stages[3]).collect()}
    want = Counter({tuple(r): copies[r.doc_id] for r in stages[3].collect() if copies[r.doc_id]})
    assert rows(stages[4]) == want


def test_bpe_stage(stages):
    ref = Reference.from_file(vocabulary())
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    got = stages[5].collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in stages[4].collect())
    for r in got:
        assert r.ids == ref.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_is_the_stages_in_order(spark, sf, stages):
    got = pipeline.run(spark, sf)
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == Counter(
        (r.doc_id, r.n_tokens) for r in stages[5].collect()
    )


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, sf, name, stage):
    docs = odd_docs(spark)
    got = stage(spark, docs, sf)
    got.collect()
    if name != "bpe":
        assert got.columns == docs.columns
    assert stage(spark, empty_docs(spark), sf).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got) > 0
    if name in ORACLE:
        assert compare(got, connect(sf).execute(ORACLE[name]).df()) is None


def test_bpe_query(spark, sf):
    import hashlib

    ref = Reference.from_file(vocabulary())
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe"](spark, sf).collect():
        ids = ref.encode(docs[r.doc_id], add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(ref.decode(ids, skip_special_tokens=False))
