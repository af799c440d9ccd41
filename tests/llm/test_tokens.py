"""Token files and n-best segmentation: exact round trips and brute force."""

import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import nbest, queries, token_files
from lakemart.llm.tables import table
from tests.llm.conftest import words

WORD_PATH, PIECE_PATH = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "It's don't 12 3", "<|endoftext|> x", "É́ İ ΑΣ ﬁ", "a" * 4000, "\x00\x1c\t\n", "Ünï ÇA ŸŽ ĿŁ", "'s 't 'RE", "a b"]


def library(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(WORD_PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_words_encode_like_whole_texts(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()][:400]
    texts += [t or "" for t in ODD] + ["ab " * 400_000, "q" * 1_100_000 + " end", words(1, 20_000)]
    got = token_files.WordEncoder(WORD_PATH).encode(texts)
    assert [g.tolist() for g in got] == library(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30), max_size=6))
def test_any_text_encodes_like_the_library(texts):
    assert [g.tolist() for g in token_files._encoder(WORD_PATH).encode(texts)] == library(texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=200), min_size=1, max_size=12))
def test_shard_round_trip(documents_ids):
    docs = [np.array(d, np.uint32) for d in documents_ids]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    shard = token_files.Shard(token_files.pack(range(len(docs)), ids, ends))
    assert (shard.all_ids() == ids).all()
    assert (token_files.expand(shard.symbols, shard.rules) == ids).all()
    assert all((shard.document(k) == d).all() for k, d in enumerate(docs))
    for start, stop in ((0, len(ids)), (len(ids) // 3, len(ids) // 2 + 1)):
        if start < stop <= len(ids):
            assert (shard.ids(start, stop) == ids[start:stop]).all()


def test_grammar_saves_symbols_and_uses_earlier_rules():
    ids = np.tile(np.arange(16, dtype=np.uint32), 500)
    rules, symbols, _ = token_files.compress(ids, np.array([len(ids)]))
    assert len(symbols) * 16 <= len(ids)
    assert token_files.expansion_lengths(rules).max() >= 16
    assert all(max(r) < token_files.FIRST_RULE + k for k, r in enumerate(rules.tolist()))
    assert (token_files.expand(symbols, rules) == ids).all()


def test_token_files(spark, documents, work, monkeypatch):
    rows = [(k * 700, words(k, 300)) for k in range(40)] + [(100_000 + k, t) for k, t in enumerate(ODD)] + [(5, "twin b"), (5, "twin a"), (None, "lost"), (-3, "below")]
    token_files.write_shards(documents(rows), WORD_PATH, work.path("files"))
    got = token_files.read_documents(spark.read.parquet(work.path("files")), work).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    stored = sorted(map(tuple, got), key=lambda r: r[1])
    assert [r[0] for r in stored] == [doc_id for doc_id, _ in order]
    assert [r[1] for r in stored] == np.cumsum([0, *[r[2] for r in stored]])[:-1].tolist()
    wanted = []
    for (doc_id, _), ids in zip(order, library([t for _, t in order]), strict=True):
        own = np.array([*ids, 1], "<u4")
        wanted.append((doc_id, len(own), zlib.crc32(own)))
    assert sorted([(r[0], r[2], r[3]) for r in stored], key=str) == sorted(wanted, key=str)

    shards = spark.read.schema(token_files.SHARD_ROWS).parquet(work.path("files"))
    asked = token_files.ids_of(shards, [700, 5, 100_004, 77])
    assert sorted((r.doc_id, tuple(r.ids)) for r in asked.collect()) == sorted(
        (doc_id, (*ids, 1)) for (doc_id, _), ids in zip(order, library([t for _, t in order]), strict=True) if doc_id in (700, 5, 100_004)
    )
    assert token_files.ids_of(shards, []).count() == 0


def test_files_ascend_by_name_and_spread_ids_share_shards(spark, documents, work):
    import random

    rng = random.Random(1)
    spread = [rng.randrange(-(2**60), 2**60) for _ in range(300)]
    for name, ids in (("dense", range(300)), ("spread", spread)):
        token_files.write_shards(documents([(i, words(3, 20)) for i in ids]), WORD_PATH, work.path(name))
        files = sorted(f for f in os.listdir(work.path(name)) if f.endswith(".parquet"))
        found = []
        for file in files:
            for row in pq.read_table(f"{work.path(name)}/{file}").to_pylist():
                found += token_files.Shard(row["payload"]).doc_ids.tolist()
        assert found == sorted(ids)
        assert spark.read.parquet(work.path(name)).count() <= 4  # shuffle partitions of the tests


def test_a_hot_or_missing_id_is_spread(spark, documents, work):
    rows = [(None if k % 2 else 7, words(k, 30)) for k in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_shards(documents(rows), WORD_PATH, work.path("hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(work.path("hot"))
    assert parts.select("range").distinct().count() >= 3
    assert token_files.read_documents(parts, work).where("doc_id is null").count() == 200


def test_copies_end_as_one_symbol_each():
    one = np.random.default_rng(2).integers(0, 5000, 2000).astype(np.uint32)
    ids = np.tile(np.append(one, np.uint32(9)), 200)
    rules, symbols, ends = token_files.compress(ids, np.arange(1, 201) * 2001)
    assert len(symbols) == 200
    assert (token_files.expand(symbols, rules) == ids).all()
    assert ends.tolist() == list(range(1, 201))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=400), st.integers(1, 5))
def test_no_frequent_pair_is_left(ids, documents_):
    ends = np.sort(np.append(np.random.default_rng(len(ids)).integers(0, len(ids) + 1, documents_ - 1), len(ids)))
    rules, symbols, stops = token_files.compress(np.array(ids, np.uint32), ends)
    assert (token_files.expand(symbols, rules) == np.array(ids)).all()
    pairs = Counter()
    for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True):
        own, k = symbols[a:b].tolist(), 0
        seen = set()
        while k + 1 < len(own):  # occurrences that do not overlap
            pair = (own[k], own[k + 1])
            if pair[0] != pair[1] or k - 1 not in seen:
                pairs[pair] += 1
                seen.add(k)
            k += 1
    assert max(pairs.values(), default=0) < 2 * token_files.LEAST


def test_other_tokenizers_are_given_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = token_files.WordEncoder(path)
    assert not other.by_words and token_files.WordEncoder(WORD_PATH).by_words
    texts = ["Two  Words\n", "it's 12 34", ""]
    wanted = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in other.encode(texts)] == wanted


def test_no_documents(spark, documents, work):
    token_files.write_shards(documents([]), WORD_PATH, work.path("none"))
    shards = spark.read.schema(token_files.SHARD_ROWS).parquet(work.path("none"))
    assert token_files.read_documents(shards, work).count() == 0
    assert nbest.digests(documents([]), PIECE_PATH).count() == 0


def test_large_blocks_take_several_shards(spark, documents, work, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 500)
    texts = [(k, words(k, 200)) for k in range(20)]
    token_files.write_shards(documents(texts), WORD_PATH, work.path("small"))
    got = token_files.read_documents(spark.read.parquet(work.path("small")), work).orderBy("doc_id").collect()
    sizes = [len(x) + 1 for x in library([t for _, t in texts])]
    assert [r.start for r in got] == [sum(sizes[:k]) for k in range(20)]


@pytest.fixture(scope="module")
def full():
    return nbest.Segmenter(PIECE_PATH)


def every_segmentation(pieces, text):
    marked = (nbest.SPACE + text.replace(nbest.SPACE, nbest._LITERAL).replace(" ", nbest.SPACE)) if text else ""
    upto = [[(0, ())]]
    for end in range(1, len(marked) + 1):
        upto.append([(before + score, ids + own) for start, score, own in pieces.edges(marked, end) for before, ids in upto[start]])
    return sorted(upto[-1], key=lambda s: -s[0])


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="the an.é▁\n 1Wß漢", max_size=9))
def test_n_best_against_all_segmentations(text):
    own = nbest.segmenter(PIECE_PATH, nbest.N_BEST, True)
    wanted = every_segmentation(own.pieces, text)
    ((best, scores, lists),) = own.segment([text])
    assert scores == [s / nbest.UNIT for s, _ in wanted[: nbest.N_BEST]]
    assert len({tuple(x.tolist()) for x in lists}) == len(lists)
    by_ids = {ids: score for score, ids in wanted}
    assert [by_ids[tuple(x.tolist())] / nbest.UNIT for x in lists] == scores
    assert all(nbest.decode(x.tolist(), own.pieces.surface) == text for x in lists)
    assert best.tolist() == lists[0].tolist()


def test_chunks_do_not_change_the_search(full):
    for text in ("the cat, sat", "on it. No", "aa  bb"):
        marked = nbest.SPACE + text.replace(" ", nbest.SPACE)
        whole = full.pieces.n_best(marked)
        ((_, scores, _),) = full.segment([text])
        assert scores == [s / nbest.UNIT for s, _ in whole]


def test_many_equal_segmentations(full):
    for text in ("s" * 20_000, "es" * 3_000):
        ((best, scores, lists),) = full.segment([text])
        assert len({tuple(x.tolist()) for x in lists}) == nbest.N_BEST
        assert all(nbest.decode(x.tolist(), full.pieces.surface) == text for x in lists)
        assert scores == sorted(scores, reverse=True)


def test_segmentation_of_odd_rows(documents):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "x▁y"), (50, "long " * 200_000), (51, "z" * 5_000), (51, "z" * 5_000)]
    got = nbest.digests(documents(rows), PIECE_PATH).collect()
    assert len(got) == len(rows)
    assert all(r.round_trip for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (0, 1)} == {0}
    kept = nbest.encode(documents(rows), PIECE_PATH, others=True, carry=("source",))
    assert {len(r.others) for r in kept.where("doc_id = 2").collect()} == {3}


def test_remembering_changes_nothing(monkeypatch):
    monkeypatch.setattr(nbest, "KNOWN_CHUNKS", 10)
    small, full = nbest.Segmenter(PIECE_PATH), nbest.segmenter(PIECE_PATH, nbest.N_BEST, True)
    for seed in range(6):
        texts = [words(seed, 60), "", "x" * 200, "the cat " + words(seed + 9, 5)]
        found, wanted = list(small.segment(texts)), list(full.segment(texts))
        assert [f[1] for f in found] == [w[1] for w in wanted]
        assert [[x.tolist() for x in f[2]] for f in found] == [[x.tolist() for x in w[2]] for w in wanted]
    assert len(small.known) == len(small.scores) == 10
    assert "x" * 200 not in small.known


def test_chunks_of_one_hash_are_told_apart(monkeypatch):
    own, texts = nbest.Segmenter(PIECE_PATH), ["cat hat bat", "one two"]
    wanted = [[x.tolist() for x in f[2]] for f in own.segment(texts)]
    monkeypatch.setattr(nbest, "mix", lambda x: x * 0)
    found = [[x.tolist() for x in f[2]] for f in nbest.Segmenter(PIECE_PATH).segment(texts)]
    assert found == wanted


def test_query_counts_all_documents(spark):
    got = queries.QUERIES["op8_nbest"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200
    assert all(r.round_trip and r.best_score >= r.second_score >= r.last_score for r in got)


def test_query_gives_every_segmentation(spark):
    """op8 reports all n id lists; they are those of a segmenter in this process, and every one decodes."""
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    own = nbest.segmenter(PIECE_PATH, nbest.N_BEST, True)
    got = queries.QUERIES["op8_nbest"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        ((_, scores, lists),) = own.segment([texts[r.doc_id]])
        assert r.n_lists == r.n_scores == len(scores)
        assert r.lengths == [len(x) for x in lists]
        assert r.crc32s == [zlib.crc32(x.astype("<u4")) for x in lists]
        assert all(r.round_trips)
    assert sum(r.n_lists == nbest.N_BEST for r in got) > 190
