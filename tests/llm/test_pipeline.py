"""The pipeline's stages one by one against the operators' plain versions."""

import re

import numpy as np
import public_tokenizers

import __spark_entry__
import corpus_pipeline
from lakemart.llm import mixing, nbest, quality
from lakemart.llm.hashing import utf8
from tests.llm.test_near import brute_near

FOLDER = "/root/testdata/sf0.01"


def test_pipeline(spark, work):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept, at = [], docs
    for name, stage in corpus_pipeline.STAGES:
        at = work.save(stage(spark, at, FOLDER), name)
        kept.append(at)
    assert all(k.columns == docs.columns for k in kept[:-1])
    good, exact, near, mixed, last = kept

    model = quality.train(docs, labels)
    ids = sorted(texts)
    scores = model.score(quality.features(utf8([texts[i] for i in ids])))
    passed = {i for i, s in zip(ids, scores, strict=True) if s >= 0.7}
    assert {r.doc_id for r in good.collect()} == passed
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(trusted - passed) <= 0.04 * len(trusted)

    first = {}
    for i in sorted(passed):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    assert {r.doc_id for r in exact.collect()} == set(first.values())

    _, label = brute_near([(i, texts[i]) for i in sorted(first.values())], corpus_pipeline.NEAR)
    assert {r.doc_id for r in near.collect()} == {i for i, c in label.items() if i == c}

    plan = {r.doc_id: r.copies for r in mixing.mix(near, work).collect()}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in plan.items() if n}

    surface = nbest.Segmenter(public_tokenizers.path("piece_bpe_32k.model")).pieces.surface
    rows = last.collect()
    assert len(rows) == sum(plan.values())
    assert all(nbest.decode(r.ids, surface) == texts[r.doc_id] for r in rows)
    assert all(np.diff(r.scores).max(initial=-1) <= 0 for r in rows)


def test_entry_registers_everything():
    known = __spark_entry__.queries()
    assert sorted(int(m[1]) for n in known if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))
    assert "pipeline" in known


def test_pipeline_of_nothing(spark, documents, work):
    docs = documents([]).selectExpr("doc_id", "text", "'en' lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = work.save(stage(spark, docs, FOLDER), f"none_{name}")
        assert docs.count() == 0


ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row long, _row string, ids string, digest int, scores int, rate int"


def odd_rows(texts):
    """Rows with null and repeated ids, null texts and sources, and columns named like the operators' own."""
    out = []
    for k, (doc_id, text) in enumerate(texts):
        out.append((doc_id, text, "en", None if k % 4 == 0 else f"s{k % 3}", 1, k, "x", "y", 7, 8, 9))
    return out


def test_every_stage_on_odd_rows(spark, work):
    from tests.llm.conftest import edited, words

    base = [words(k, 60, 4000) for k in range(12)]
    near = edited(base[0], 3, 1)
    texts = [(k, t) for k, t in enumerate(base)] + [(0, base[0]), (None, base[1]), (None, base[1]), (3, base[2]), (40, near)]
    texts += [(41, None), (None, None), (42, ""), (42, "  "), (43, words(5, 30_000, 4000)), (44, base[4].replace(" ", "\n"))]
    docs = spark.createDataFrame(odd_rows(texts), ODD_COLUMNS)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = work.save(stage(spark, docs, "/root/testdata/sf0.001"), f"odd_{name}")
        after[name] = kept.collect()
        if name != "sentencepiece":
            assert kept.columns == docs.columns
            known = {tuple(r) for r in docs.collect()}
            assert all(tuple(r) in known for r in after[name])
    ids = {name: [r.doc_id for r in rows] for name, rows in after.items()}
    exact = after["exact_dedup"]
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in exact]
    assert len(set(normal)) == len(normal) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts})
    by_text = {t: r.doc_id for t, r in zip(normal, exact, strict=True)}
    assert by_text[base[0]] == 0 and by_text[base[2]] == 2 and by_text[base[1]] == 1
    assert 40 not in ids["minhash_near_dedup"] and ids["minhash_near_dedup"].count(0) == 1
    assert sum(r.text is None or not r.text.strip() for r in after["minhash_near_dedup"]) == 4
    assert all((r.text or "").strip() for r in after["mixing"])
    assert len(after["sentencepiece"]) == len(texts)
    surface = nbest.Segmenter(public_tokenizers.path("piece_bpe_32k.model")).pieces.surface
    read = sorted(nbest.decode(r.ids, surface) for r in after["sentencepiece"])
    assert read == sorted(t or "" for _, t in texts)
    assert all(r.n_pieces == len(r.ids) for r in after["sentencepiece"])
