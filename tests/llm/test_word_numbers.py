"""Words of token files: numbers of hashes, and what goes to the model directly."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from lakemart.llm import token_files

WORD_PATH = public_tokenizers.path("word_bpe_49k.json")


class Counting:
    """A tokenizer that notes what takes the library's whole way."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.texts = tokenizer, tokenizer.model, []

    def encode_batch(self, texts, add_special_tokens):
        self.texts += texts
        return self.tokenizer.encode_batch(texts, add_special_tokens=add_special_tokens)


def test_plain_words_go_to_the_model_directly():
    own = token_files.WordEncoder(WORD_PATH)
    texts = ["Plain words, 12 of them!", "façade Ünï ŸŽ ĿŁ ſt ŉ ß, élan", "\x01 \x7f x"]
    wanted = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    own.tokenizer = Counting(own.tokenizer)
    assert [g.tolist() for g in own.encode(texts)] == wanted
    assert sorted(own.tokenizer.texts) == ["\x01", "\x7f"]


def test_every_plain_letter_is_spelled_like_the_library_does():
    own = token_files.WordEncoder(WORD_PATH)
    texts = [f"a{c}b {c} {c}{c}x" for c in sorted(token_files._PLAIN)]
    wanted = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in own.encode(texts)] == wanted


@pytest.mark.parametrize("same_bits", [0, 40, 60])
def test_hashes_of_one_place_get_numbers_of_their_own(same_bits):
    found = token_files._Numbers(500)
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(1, 1 << 62, 700, dtype=np.uint64) >> np.uint64(same_bits))[:500]
    rng.shuffle(hashes)
    found.add(hashes[:200])
    found.add(hashes[200:])
    assert found.find(hashes).tolist() == list(range(len(hashes)))
    assert (found.find(hashes + np.uint64(1 << 63)) == -1).all()


def test_words_are_forgotten_where_room_ends(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 8)
    small, full = token_files.WordEncoder(WORD_PATH), token_files._encoder(WORD_PATH)
    small._reset(8)
    for k in range(6):
        texts = [f"{chr(97 + k)}{chr(97 + j)} common été" for j in range(k + 2)] + [""]
        assert [g.tolist() for g in small.encode(texts)] == [g.tolist() for g in full.encode(texts)]
        assert small.known.size <= small.most


@pytest.mark.parametrize("high", [1 << 5, 1 << 31])
def test_frequent_pairs_are_counted_exactly(high):
    rng = np.random.default_rng(high)
    symbols = (rng.integers(0, 12, 900) + high - 12).astype(np.uint32)
    places = np.flatnonzero(rng.random(899) < 0.8)
    best, at, rank = token_files._sorted_places(symbols, places)
    counts = Counter((int(symbols[p]) << 32) + int(symbols[p + 1]) for p in places)
    wanted = sorted((c for c in counts if counts[c] >= token_files.LEAST), key=lambda c: (-counts[c], c))
    assert best.tolist() == wanted
    assert at.tolist() == [p for p in places if (int(symbols[p]) << 32) + int(symbols[p + 1]) in wanted]
    assert [wanted[r] for r in rank] == [(int(symbols[p]) << 32) + int(symbols[p + 1]) for p in at]


def skewed_documents(seed, n=60_000):
    """Ids of which few are frequent, runs and copies among them, and the ends of their documents."""
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.zipf(1.3, n), 40_000).astype(np.uint32)
    ids[n // 3 : n // 3 + 50] = 7
    ids[n // 2 : n // 2 + 9_000] = np.tile(ids[:900], 10)
    return ids, np.append(np.sort(rng.integers(0, n, 40)), n)


def test_rare_pairs_are_counted_once(monkeypatch):
    counted, plain = [], token_files._sorted_places

    def noted(symbols, places, *more):
        counted.append(len(places))
        return plain(symbols, places, *more)

    monkeypatch.setattr(token_files, "_sorted_places", noted)
    ids, ends = skewed_documents(3)
    rules, symbols, _ = token_files.compress(ids, ends)
    assert (token_files.expand(symbols, rules) == ids).all()
    assert counted[-1] < len(symbols) // 100  # the last round, which counts all pairs that may still be frequent


@pytest.mark.parametrize("seed", range(4))
def test_grammar_is_the_same_where_rare_pairs_are_counted_again(seed, monkeypatch):
    ids, ends = skewed_documents(seed)
    got = token_files.compress(ids, ends)
    plain = token_files._sorted_places
    monkeypatch.setattr(token_files, "_sorted_places", lambda symbols, places, state: plain(symbols, places))
    wanted = token_files.compress(ids, ends)
    assert all(np.array_equal(a, b) for a, b in zip(got, wanted, strict=True))
    assert len(got[0]) > 500


@pytest.mark.parametrize("spelled", [0, 1 << 23])
def test_all_ids_are_read_back_either_way(spelled, monkeypatch):
    monkeypatch.setattr(token_files, "SPELLED", spelled)
    ids, ends = skewed_documents(9)
    shard = token_files.Shard(token_files.pack(range(len(ends)), ids, ends))
    assert (shard.all_ids() == ids).all()
    assert all((shard.document(k) == ids[a:b]).all() for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)))


@pytest.mark.parametrize("few", [0, 1 << 11])
def test_places_are_left_out_either_way(few, monkeypatch):
    monkeypatch.setattr(token_files, "FEW_PLACES", few)
    values = np.arange(300, dtype=np.uint32)
    for places in ([0], [299], [4, 5, 6], [0, 1, 150, 298, 299]):
        got = token_files._without(np.array(places), values, values * 2)
        assert [g.tolist() for g in got] == [np.delete(values, places).tolist(), np.delete(values * 2, places).tolist()]


def test_plain_texts_are_those_of_plain_characters():
    for c in range(0x3000):
        assert (token_files._NOT_PLAIN.search(chr(c)) is None) == (chr(c) in token_files._PLAIN)
