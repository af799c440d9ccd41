"""The quality and toxicity models: held-out accuracy, and that held-out labels and other columns are never used."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import quality, toxicity
from lakemart.llm.hashing import utf8

FOLDER = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert all(held(i) for i in scored.doc_id)
    assert scored.score.between(0, 1).all()
    good, bad = scored[scored.quality == 1], scored[scored.quality == 0]
    assert good.predicted.mean() > 0.97
    assert bad.predicted.mean() < 0.05
    assert ((scored.score >= 0.7) == scored.predicted).all()


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    chain = toxicity.train(docs, labels)
    scored = toxicity.score(docs, chain).join(labels, "doc_id").where("held_out").toPandas()
    assert scored[scored.toxic == 1].predicted.mean() > 0.85
    assert scored[scored.toxic == 0].predicted.mean() < 0.02


def test_held_out_labels_change_nothing(tables):
    docs, labels = tables
    docs, labels = docs.limit(1500).cache(), labels.cache()
    turned = labels.withColumns({c: F.when(quality.held_out(), 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert (a.weights == b.weights).all()
    assert a.bias == b.bias
    one, two = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert all((x[0] == y[0]).all() for x, y in zip(one.models, two.models, strict=True))


def test_positives_and_unlabelled_rows_suffice():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 20)).astype(np.float32)
    x[:1200, 0] += 4
    model = quality.fit_nnpu(x[:600], x, prior=0.4)
    scores = model.score(x)
    assert (scores[:1200] >= 0.5).mean() > 0.9
    assert (scores[1200:] >= 0.5).mean() < 0.1


def test_features_read_whole_texts():
    tail = "A" * 10 + "!" * 200_000
    a, b = quality.features(utf8(["abc " * 50_000, "abc " * 50_000 + tail]))
    assert np.abs(a - b).max() > 0.3
    assert np.isfinite(quality.features(utf8(["", None, "x", "\n"]))).all()


def test_chain_learns_from_earlier_categories():
    """The second category is the first one's, so its model leans on the probability before it."""
    rng = random.Random(1)
    texts, first = [], []
    for k in range(1200):
        bad = k % 4 == 0
        texts.append(" ".join([f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(20)] + (["vile"] if bad else [])))
        first.append(float(bad))
    found, _, own, _ = toxicity.buckets(utf8(texts))
    rows = toxicity.Rows(found, np.append(0, np.cumsum(own)))
    y = np.array(first)
    chain = toxicity.fit_chain(rows, {"a": y, "b": y}, np.arange(len(y)) % 5)
    assert len(chain.models[1][0]) == len(chain.models[0][0]) + 1
    assert chain.models[1][0][-1] > 0
    out = chain.predict(utf8(["so vile", "so kind"]))
    assert (out[0] > 0.5).all()
    assert (out[1] < 0.5).all()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, documents, module):
    rows = [(1, None), (2, ""), (3, "Ä " * 300_000), (None, "some words"), (4, "some words"), (4, "some words"), (5, "\x00")]
    docs = documents(rows).withColumn("held_out", F.lit("clash")).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1), (4, 1, None), (None, 1, 1), (9, None, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = module.train(docs, known)
        out = module.score(docs, model).collect()
        assert len(out) == len(rows)
        value = "score" if module is quality else "toxic_score"
        assert all(0 <= r[value] <= 1 for r in out)
        assert len({r[value] for r in out if r.doc_id == 4 or r.doc_id is None}) == 1
    assert module.score(documents([]), module.train(documents([]), labels)).count() == 0


def test_good_docs_keeps_columns(documents):
    docs = documents([(1, "fine text"), (2, None)])
    kept = quality.good_docs(docs, quality.Model())
    assert kept.columns == docs.columns
    assert kept.count() == 2
