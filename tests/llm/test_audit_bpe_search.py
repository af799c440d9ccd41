"""Source divergence, byte-level BPE and ball-tree search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import ball_search, byte_bpe, divergence
from tests.conftest import rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "long Text " * 60_000 + "x" * 300_000


# ---------------------------------------------------------------- divergence


def plain_audit(table, top=200, least=3):
    """The audit of (text, lang, source) rows, spelled out."""
    held, count, groups = defaultdict(Counter), Counter(), set()
    for text, lang, source in [tuple(v or "" for v in row) for row in table]:
        groups.add((lang, source))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(UPPER))
        held[lang].update(set(words))
        count.update((lang, source, w) for w in words)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for w, n in held[lang].items() if n >= least]
        sources = sorted(s for l, s in groups if l == lang)

        def share(of, kept=kept, lang=lang):
            total = sum(of(w) for w in kept)
            return {w: 1 + 10**9 * (of(w) + 1) // (total + len(kept)) for w in kept}

        p = {s: share(lambda w, s=s, lang=lang: count[lang, s, w]) for s in sources}
        q = share(lambda w, sources=sources, lang=lang: sum(count[lang, s, w] for s in sources))
        for s in sources:
            pairs = {t: sum((p[s][w] - p[t][w]) ** 2 // p[t][w] for w in kept) for t in sources if t != s}
            terms = {w: (p[s][w] - q[w]) ** 2 // q[w] for w in kept if count[lang, s, w] and p[s][w] > q[w]}
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                best = sorted(values.items(), key=lambda e: (-e[1], e[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(best)}
    return out


def audited(spark, work, table):
    docs = spark.createDataFrame([(*r, 1, "x") for r in table], "text string, lang string, source string, n long, term string")
    return {tuple(r) for r in divergence.audit(docs, work).collect()}


def test_audit_equals_brute_force(spark, work, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_CELLS", 40)
    rng = random.Random(4)
    vocabulary = ["Ab", "ab", "é", "É", "日本", "z", "don", "\U0001f600x", *[f"w{chr(97 + k)}" for k in range(20)]]
    table = []
    for _ in range(150):
        words = [rng.choice(vocabulary) + rng.choice([" ", "1", "\x00", "'", "\n"]) for _ in range(rng.randrange(30))]
        table.append(("".join(words), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None, "ß"])))
    table += [(None, "fr", "s1"), ("", "fr", "s2"), ("once only here", "it", "s1"), (None, None, "only")]
    table += [("copy copy Copy", "en", "s1")] * 40 + [(LONG, "en", "s2")]
    assert audited(spark, work, table) == plain_audit(table)


def test_audit_of_odd_tables(spark, work):
    assert audited(spark, work, []) == set()
    assert audited(spark, work, [(None, None, None)]) == set()
    assert audited(spark, work, [("a", "en", "s"), (None, "en", None)]) == {
        ("en", "s", "pair", "", 0, 1), ("en", "", "pair", "s", 0, 1),
    }


def test_shares_are_exact_for_huge_counts():
    counts = np.array([[0, 10**14, 3 * 10**15 + 7, 123456789012345]], np.int64)
    totals = np.array([9 * 10**15 - 1, 10**14 + 3, 4 * 10**15 + 1, 123456789012347])
    wanted = [1 + 10**9 * (int(c) + 1) // int(t) for c, t in zip(counts[0], totals, strict=True)]
    assert divergence.shares(counts, totals)[0].tolist() == wanted


def test_highest_terms_settle_ties_by_bytes():
    values = np.array([5, 7, 5, 5, 1])
    assert divergence._highest(values, [b"d", b"x", b"a", b"c", b"b"], 3) == [1, 2, 3]


def test_counts_leave_a_task_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 8)
    import pyarrow as pa

    texts = [f"a{chr(98 + k % 20)} b" for k in range(50)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 50, "source": ["s"] * 50, "text": texts})
    parts = list(divergence._partial_counts(batch.slice(k, 2) for k in range(0, 50, 2)))
    assert len(parts) > 5
    total = Counter()
    for part in parts:
        for r in part.to_pylist():
            total[r["term"]] += r["n"]
    assert total["b"] == 50


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(PATH)


def encoded(encoder, texts):
    ids, ends = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in pairwise([0, *ends.tolist()])]


ODD = [
    "", "aaaaaaa" * 40, "<|endoftext|> x<|endoftext|><|endoftext|>", "<|endoftext", "É İ ΑΣ ﬁ 日本語 ½ ² ٣", "It's we'LL I'd 'S ''s",
    "a\x85b\xa0c    d\x1c\x1d e\n\n\n f ", "͸ \U0001f600 á", "     x    \t y  ", "\x00\x01\x7f", " " * 400, " 　x", "é‍",
]


def test_texts_encode_like_the_library(encoder, library):
    rng = random.Random(2)
    letters = ["ab", "abcdefghijklmnopqrstuvwxyz '", "thein  \n\t\r.,!?'sdlm0123456789", "éßŁñ\x85\xa0ſ²½ aeio'\x1c", "日本ΑΣ ́😀a"]
    texts = ODD + ["".join(rng.choices(rng.choice(letters), k=rng.randrange(60))) for _ in range(4000)]
    found = encoded(encoder, texts)
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.decode(f) for f in found] == [library.decode(f, skip_special_tokens=False) for f in found]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_any_text_encodes_like_the_library(encoder, library, texts):
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_any_ids_decode_like_the_library(encoder, library, ids):
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_token_is_its_own_encoding(encoder):
    words = sorted(encoder.vocabulary.ids)
    assert [w[0] for w in byte_bpe.encode_words(words, encoder.vocabulary)] == [encoder.vocabulary.ids[w] for w in words]


def test_a_shared_prefix_is_walked_once(encoder, monkeypatch):
    words = sorted({b"inter" + bytes([97 + k, 97 + j]) for k in range(20) for j in range(20)})
    shared = byte_bpe.shared_lengths(words)
    assert sum(len(w) - s for w, s in zip(words, shared, strict=True)) == 5 + 20 + 400
    looked_up = Counter()

    class Counting(dict):
        def __getitem__(self, key):
            looked_up["steps"] += 1
            return super().__getitem__(key)

    monkeypatch.setattr(encoder.vocabulary, "before", Counting(encoder.vocabulary.before))
    byte_bpe.encode_words(words, encoder.vocabulary)
    walked = looked_up["steps"]
    for word in words:
        byte_bpe.encode_words([word], encoder.vocabulary)
    assert walked * 3 < looked_up["steps"] - walked


def test_memory_is_bounded_and_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 50)
    monkeypatch.setattr(byte_bpe, "KNOWN_PAIRS", 20)
    small = byte_bpe.Encoder(PATH)
    rng = random.Random(5)
    for _ in range(20):
        texts = ["".join(rng.choices("abcdeth in", k=200)) for _ in range(5)] + ["y" * 200]
        assert encoded(small, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(small._known) <= 50 and len(small.vocabulary.pairs) <= 20
    assert "y" * 200 not in small._known


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        byte_bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_encoded_documents_round_trip(spark, documents, library):
    table = [(3, "Hello <|endoftext|> world"), (None, "null id"), (3, None), (5, ""), (7, LONG), (7, LONG), (9, "日本 a")]
    docs = documents(table)
    found = byte_bpe.encode(docs, PATH, carry=("doc_id", "source", "digest"), decoded=True)
    assert found.columns == ["doc_id", "source", "digest", "ids", "decoded"]
    wanted = sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in table), key=str)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found.collect()), key=str) == wanted
    assert rows(byte_bpe.decode(found, PATH), "doc_id", "text") == sorted([(i, t) for i, _, t in wanted], key=str)
    assert byte_bpe.encode(documents([]), PATH).count() == 0
    digest = {r.doc_id: r for r in byte_bpe.digests(found).collect()}
    assert digest[5].n_tokens == 0 and digest[5].ids_sha256 == digest[5].decoded_sha256


# ---------------------------------------------------------------- ball-tree search


def plain_search(docs, items, top=10):
    """Scores by the contract, document by document; docs and items are (id, text) rows."""

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    words = [terms(t) for _, t in docs]
    tfs = [Counter(w) for w in words]
    n_docs, n_words = sum(map(bool, words)), sum(map(len, words))
    df = Counter(t for tf in tfs for t in tf)
    queries = defaultdict(list)
    for i, text in items:
        queries[i] += terms(text)
    out = []
    for i, query in queries.items():
        scored = []
        for (doc, _), own, tf in zip(docs, words, tfs, strict=True):
            m = 25 + (75 * len(own) * n_docs) // n_words if own else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in query if tf[t]
            )
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        best = sorted(scored)[:top]
        out += [(i, k + 1, doc if there else None, -score) for k, (score, there, doc) in enumerate(best)]
    return sorted(out, key=str)


def found_by(spark, work, docs, items):
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n long, terms string")
    queries = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, term string")
    return rows(ball_search.search(table, queries, work), "item_id", "rank", "doc_id", "score")


def corpus(seed, n, vocabulary=300):
    rng = random.Random(seed)
    words = [f"W{k}" for k in range(vocabulary)] + ["é1", "日本", "ß"]
    docs = [(k, " ".join(words[min(int(rng.expovariate(0.02)), len(words) - 1)] for _ in range(rng.randrange(1, 60)))) for k in range(n)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for k in range(25)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_search_equals_brute_force(spark, work, monkeypatch, seed):
    if seed == 2:
        monkeypatch.setattr(ball_search, "BLOCK_TERMS", 300)
        monkeypatch.setattr(ball_search, "SLICE_CELLS", 1 << 12)
    docs, items = corpus(seed, 900)
    docs += [(5, docs[5][1]), (None, docs[5][1]), (5, docs[5][1]), (901, None), (902, ""), (903, "- ,.")]
    docs += [(1000 + k, docs[7][1]) for k in range(40)] + [(2000, LONG + " W1 W2"), (2001, "W3")]
    items += [(100, docs[7][1]), (101, None), (102, "unheard of"), (None, "w1 W1 w9"), (3, "w250"), (103, LONG)]
    assert found_by(spark, work, docs, items) == plain_search(docs, items)


def test_search_of_empty_tables(spark, work):
    assert found_by(spark, work, [], [(1, "a")]) == []
    assert found_by(spark, work, [(1, "a")], []) == []
    assert found_by(spark, work, [(1, None), (2, "")], [(1, "a"), (2, None)]) == []


def test_no_bound_is_below_a_score_and_subtrees_are_pruned():
    rng = np.random.default_rng(3)
    rows_, width = 2000, 120
    topics = rng.integers(0, 8, rows_)
    lists = [np.unique(rng.choice(15, 6) + 15 * t) for t in topics]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    terms = np.concatenate(lists).astype(np.int64)
    impacts = rng.integers(1, 1_000_000, len(terms))
    weights = rng.integers(0, 20_000, width)
    tree = ball_search.Tree(ends, terms, impacts, np.sqrt(weights))
    assert sorted(tree.order.tolist()) == list(range(rows_))
    assert sum(c is None for c in tree.children) == sum(b - a <= ball_search.LEAF for a, b in tree.spans)
    items = np.zeros((30, width), np.int64)
    for k in range(30):
        items[k, rng.choice(15, 5) + 15 * (k % 8)] = rng.integers(1, 4, 5)
    dense = np.zeros((rows_, width), np.int64)
    dense[np.repeat(np.arange(rows_), np.diff(ends)), terms] = impacts
    scores = dense @ (items * weights).T
    bounds = tree.bounds(items * np.sqrt(weights))
    for node, (start, stop) in enumerate(tree.spans):
        assert (bounds[node] >= scores[tree.order[start:stop]].max(axis=0)).all()
    scored = 0
    for k in range(30):
        best = []
        scored += tree.search(bounds[:, k].tolist(), items[k] * weights, list(range(rows_)), best, 10)
        wanted = sorted((-int(s), 1, d) for d, s in enumerate(scores[:, k]) if s > 0)[:10]
        assert best == wanted
    assert scored < 30 * sum(c is None for c in tree.children) / 2


def test_equal_rows_make_a_balanced_tree():
    rows_ = 5000
    tree = ball_search.Tree(np.arange(rows_ + 1), np.zeros(rows_, np.int64), np.full(rows_, 7), np.ones(3))
    assert max(b - a for (a, b), c in zip(tree.spans, tree.children, strict=True) if c is None) <= ball_search.LEAF
    assert len(tree.spans) < rows_
