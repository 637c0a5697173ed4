"""Toxicity and quality: held-out accuracy, bounds and odd rows."""

import random

import numpy as np
import pytest
import zstandard
from odd import empty_docs, odd_docs, prose
from pyspark.sql import functions as F

from basinflow.llm import compression, quality, toxicity
from basinflow.llm.queries import held_out

BAD = ["blockhead", "nitwit", "vermin", "rubbish"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(500):
        words = prose(i, rng.randrange(30, 200)).split()
        toxic, poor = int(rng.random() < 0.3), int(rng.random() < 0.3)
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        if poor:
            words = [w + rng.choice(("###", "%%%", "$$$")) for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, 1 - poor, toxic))
    labels += [(0, 1, 0), (0, 0, 1), (None, 1, 1), (1, None, None), (9999, 1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").cache(),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache(),
    )


@pytest.mark.parametrize("module, col", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, labelled, module, col):
    docs, labels = labelled
    model = module.learn(docs, labels, ~held_out())
    got = module.score(docs, model).join(labels, "doc_id").filter(held_out() & (F.col("doc_id") > 0))
    rows = got.select("score", "predicted", F.col(col).alias("y")).filter("y IS NOT NULL").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted == r.y for r in rows]) > 0.9


def test_labels_of_the_held_out_fold_do_not_matter(spark, labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.learn(docs, x, ~held_out()) for x in (labels, turned))
    assert one.target == two.target and one.ordinary == two.ordinary and (one.weights == two.weights).all()


def test_odd_rows_and_scores_by_text_alone(spark, labelled):
    docs, labels = labelled
    model = toxicity.learn(docs, labels, ~held_out())
    odd = odd_docs(spark)
    got = toxicity.score(odd, model)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == odd.count()
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[5] == by_id[6] == by_id[7] and by_id[1] == by_id[2] and len(by_id[10]) == 1
    kept = quality.keep(odd, quality.learn(docs, labels, ~held_out()))
    assert kept.columns == odd.columns
    assert toxicity.score(empty_docs(spark), model).count() == 0


def test_without_labels_the_score_is_the_share(spark, labelled):
    docs, labels = labelled
    none = toxicity.learn(docs, labels.limit(0), ~held_out())
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    same = toxicity.learn(docs, labels.filter("toxic = 0"), ~held_out())
    assert max(r.score for r in toxicity.score(docs, same).collect()) < 0.05


def test_learning_is_bounded(spark, labelled):
    docs, labels = labelled
    bound = compression.Settings(learn_docs=20, learn_bytes=4_000)
    model = toxicity.learn(docs, labels, ~held_out(), settings=bound)
    assert len(model.target) <= bound.target_bytes + 8 and len(model.ordinary) <= bound.ordinary_bytes
    every = toxicity.learn(docs, labels, ~held_out())
    assert len(model.ordinary) < len(every.ordinary)


def test_late_parts_of_long_documents_are_learned(spark):
    rng = random.Random(2)
    docs = [(i, prose(i, 6_000) + (f" {' '.join(rng.choices(BAD, k=6))}" if i % 2 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    assert min(len(t) for _, t in docs) > 25_000
    model = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string"), labels, ~held_out())
    assert sum(w.encode()[:5] in model.target for w in BAD) >= 3
    some = spark.createDataFrame([(1, prose(900, 50)), (2, prose(901, 50) + " vermin nitwit rubbish")], "doc_id long, text string")
    low, high = (r.score for r in toxicity.score(some, model).orderBy("doc_id").collect())
    assert high > low


def test_scores_equal_recomputed_ones(spark, labelled):
    docs, labels = labelled
    model = toxicity.learn(docs, labels, ~held_out())
    kinds = [zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
             for x in (model.ordinary, model.target + model.ordinary)]
    some = docs.limit(40).collect()
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for number, text in some:
        words = text.encode().split()
        windows = [b" " + b" ".join(words[i : i + 24]) + b" " for i in range(0, len(words), 24)]
        sizes = []
        for held in kinds:
            held.precompute_compress(level=6)
            packer = zstandard.ZstdCompressor(
                level=6, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append([len(packer.compress(w)) for w in windows])
        a, b, n = np.array(sizes[0], float), np.array(sizes[1], float), np.array([len(w) for w in windows], float)
        saved = sorted(a - b, reverse=True)
        figures = [saved[0], sum(saved[:3]), 100 * sum(saved) / n.sum(), sum(x >= 3 for x in saved) / max(3, len(n)),
                   a.sum() / (n.sum() + 1), b.sum() / (n.sum() + 1), np.log1p(len(n)), np.median(a / n)]
        z = [min(4, max(-4, (f - m) / d)) for f, m, d in zip(figures, model.mean, model.spread)]
        line = sum(w * x for w, x in zip(model.weights, [*z, *(x * x for x in z), 1]))
        assert got[number] == pytest.approx(1 / (1 + np.exp(-line)), abs=1e-9)


def test_long_texts_are_read_in_pieces():
    text = ("word " * 300_000).strip()
    model = compression.Settings()
    whole = compression.Scorer(b"nitwit vermin", b"some ordinary words", model)
    assert whole.features(text + " nitwit vermin nitwit")[6] > np.log1p(12_000)
