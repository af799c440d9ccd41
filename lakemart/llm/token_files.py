"""Token-id files with Re-Pair grammar compression.

Documents are encoded in ascending doc_id order and stored in shards of about two million ids. In each shard the most
frequent pairs of ids are replaced by nonterminals, thousands of pairs a round, until no pair is left that occurs
``LEAST`` times. A shard holds its rules, their expansion lengths, the symbols left, and where each document starts, so
any document, or any id of it, is read without the rest.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.hashing import CHUNK, IS_SPACE, bounds_hash, buffers
from lakemart.llm.tables import running_total, text_or_empty
from lakemart.sources.lake import Workspace

SHARD_IDS = 1 << 21
FIRST_RULE = 1 << 17
RULES_A_ROUND, LEAST, PASSES = 1 << 14, 6, 5
OPEN, RARE, LAST = 0, 1, 2  # a pair that may be replaced, one too rare, one that would reach over a document's end
FEW_PLACES = 1 << 11
KNOWN_WORDS = 1 << 20
SPELLED = 1 << 23
END_ID = 1
_MAGIC = b"RPG1"


# ---------------------------------------------------------------- grammar


Places = tuple[np.ndarray, np.ndarray, np.ndarray]


def _sorted_places(symbols: np.ndarray, places: np.ndarray, state: np.ndarray | None = None) -> Places:
    """The most frequent pairs among those that start at ``places``: (codes, most frequent first; places where one starts,
    ascending; its rank there). In ``state``, places of pairs that occur less than LEAST times are noted as RARE.
    """
    none = np.zeros(0, np.int64)
    if not len(places):
        return none, none, none
    in_order, order, high = _sorted_codes(symbols, places)
    firsts = np.flatnonzero(in_order[1:] != in_order[:-1])
    firsts += 1
    firsts = np.append(0, firsts)
    counts = np.diff(firsts, append=len(places))
    full = np.flatnonzero(counts >= LEAST)
    full = full[np.argsort(-counts[full], kind="stable")]  # the most frequent first, equal ones by code
    ranks = np.full(len(firsts), -1, np.int32)
    ranks[full] = np.arange(len(full), dtype=np.int32)
    own = np.empty(len(places), np.int32)
    own[order] = np.repeat(ranks, counts)
    if state is not None:
        state[places[np.flatnonzero(own < 0)]] = RARE
    best = in_order[firsts[full[:RULES_A_ROUND]]]
    here = np.flatnonzero(own.view(np.uint32) < len(best))  # below 0 is above all
    return (best >> high << 32) | (best & ((1 << high) - 1)), places[here], own[here]


def _sorted_codes(symbols: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes of the pairs at ``places`` in ascending order, the number of each one's place, and the bits of a code's
    second half.

    Where a pair's two symbols and the number of its place fit into one number, those are sorted, which is faster by far.
    """
    high, bits = int(symbols.max()).bit_length(), len(places).bit_length()
    if 2 * len(places) > len(symbols):
        codes = symbols[:-1].astype(np.int64)
        codes <<= high
        codes |= symbols[1:]
        codes = codes[places]
    else:
        codes = symbols[places].astype(np.int64)
        codes <<= high
        codes |= symbols[places + 1]
    if 2 * high + bits > 63:
        order = np.argsort(codes, kind="stable")
        return codes[order], order, high
    codes <<= bits
    codes |= np.arange(len(codes))
    codes.sort()
    order = codes & ((1 << bits) - 1)
    codes >>= bits
    return codes, order, high


def _apart(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Numbers of the places to replace, so that no two overlap: in turns, those of better rank than both neighbours, and
    in a run of one pair every second place from its first."""
    touch = at[1:] == at[:-1] + 1
    repeats = np.flatnonzero(touch & (rank[1:] == rank[:-1])) + 1  # in a run, after its first
    index = np.arange(len(repeats))
    begins = np.append(True, repeats[1:] != repeats[:-1] + 1)[: len(repeats)]
    odd = repeats[(index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 0]
    touch[odd - 1] = False
    touch[odd[odd < len(touch)]] = False
    chosen, alive = np.zeros(0, np.int64), np.arange(0)
    for turn in range(PASSES):
        first = rank[:-1] <= rank[1:]
        win = np.ones(len(at), bool)
        win[1:] = ~(touch & first)
        win[:-1] &= first | ~touch
        stay = ~win
        stay[1:] &= ~(touch & win[:-1])
        stay[:-1] &= ~(touch & win[1:])
        if not turn:
            win[odd] = stay[odd] = False
        won, stay = np.flatnonzero(win), np.flatnonzero(stay)
        chosen, alive = (np.append(chosen, alive[won]), alive[stay]) if turn else (won, stay)
        if not len(alive):
            break
        at, rank = at[stay], rank[stay]
        touch = at[1:] == at[:-1] + 1
    return np.sort(chosen)


def _replaced(best: np.ndarray, at: np.ndarray, rank: np.ndarray) -> Places:
    """The pairs that are worth a rule, and the places that use one: no two overlap, and every rule is used LEAST times."""
    chosen = _apart(at, rank)
    at, rank = at[chosen], rank[chosen]
    worth = np.bincount(rank, minlength=len(best)) >= LEAST
    if worth.all():
        return best, at, rank
    used = np.flatnonzero(worth[rank])
    return best[worth], at[used], (np.cumsum(worth, dtype=np.int32) - np.int32(1))[rank[used]]


def _beside(at: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Places of the pairs that hold one of the symbols ``at`` these places, ascending."""
    if len(at) > len(state) // 16:
        beside = np.zeros(len(state) + 1, bool)
        beside[at] = beside[at - 1] = True  # the one before the first is the last of all
        return np.flatnonzero(beside[:-1] & (state != LAST))
    places = np.stack([at - 1, at], axis=1).ravel()
    places = places[np.append(True, places[1:] != places[:-1])]
    places = places[places >= 0]
    return places[state[places] != LAST]


def _without(places: np.ndarray, *arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays without these places; where they are few, the runs between them are copied whole."""
    if len(places) > FEW_PLACES:
        stay = np.ones(len(arrays[0]), bool)
        stay[places] = False
        stay = np.flatnonzero(stay)
        return [values[stay] for values in arrays]
    runs = list(zip([0, *(places + 1).tolist()], [*places.tolist(), len(arrays[0])], strict=True))
    return [np.concatenate([values[a:b] for a, b in runs]) for values in arrays]


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as pairs, symbols, end positions of the documents in them); no rule reaches over a document's end.

    Rule k is symbol FIRST_RULE + k and may use earlier rules only. Of overlapping occurrences the more frequent pair
    is replaced, in runs of one symbol every second pair. A round after another counts pairs with the newest symbols
    only, as no other pair has become more frequent; where it finds none, all pairs are counted but those that were
    rare before. Every round makes a rule and takes symbols away, so the rounds end; copies of a text halve in each.
    """
    symbols = ids.astype(np.uint32)
    state = np.full(len(symbols), OPEN, np.uint8)  # of the pair that starts at a place
    state[ends[ends > 0] - 1] = LAST
    rules = [np.empty((0, 2), np.uint32)]
    made, fresh = 0, 0
    at = np.zeros(0, np.int64)
    while len(symbols) >= 2 * LEAST:
        places = _beside(at, state) if fresh else np.flatnonzero(state == OPEN)
        state[places] = OPEN
        best, at, rank = _replaced(*_sorted_places(symbols, places, state))
        if not len(at):
            if not fresh:  # all pairs have been counted
                break
            fresh = 0
            continue
        rules.append(np.stack([best >> 32, best & 0xFFFFFFFF], axis=1).astype(np.uint32))
        fresh = FIRST_RULE + made
        symbols[at] = rank + np.uint32(fresh)
        made += len(best)
        state[at] = state[at + 1]
        symbols, state = _without(at + 1, symbols, state)
        at = at - np.arange(len(at))  # where the newest symbols are now
    symbol_ends = np.zeros(len(ends), np.int64)
    symbol_ends[np.diff(ends, prepend=0) > 0] = np.flatnonzero(state == LAST) + 1
    return np.concatenate(rules), symbols, np.maximum.accumulate(symbol_ends)


def _levels(rules: np.ndarray) -> list[np.ndarray]:
    """Numbers of the rules, those first that need ids only, then those that need these, and so on."""
    out, todo = [], np.arange(len(rules))
    known = np.zeros(len(rules) + 1, bool)
    while len(todo):
        sides = rules[todo].astype(np.int64) - FIRST_RULE
        ready = ((sides < 0) | known[np.maximum(sides, 0)]).all(axis=1)
        out.append(todo[ready])
        known[todo[ready]] = True
        todo = todo[~ready]
    return out


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """How many ids each rule stands for."""
    lengths = np.ones(len(rules), np.int64)
    for level in _levels(rules):
        sides = rules[level].astype(np.int64) - FIRST_RULE
        lengths[level] = np.where(sides < 0, 1, lengths[np.maximum(sides, 0)]).sum(axis=1)
    return lengths


def _spelled(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Ids of symbols, each of which is spelled out in ``flat``."""
    many = sizes[symbols]
    ends = np.cumsum(many)
    where = np.repeat(starts[symbols] - (ends - many), many)
    where += np.arange(len(where))
    return flat[where]


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that a few symbols stand for; only the rules that they need are looked at."""
    out = symbols.astype(np.uint32)
    while True:
        inner = out >= FIRST_RULE
        if not inner.any():
            return out
        places = np.cumsum(1 + inner) - 1 - inner
        wider = np.empty(int(places[-1]) + 1 + int(inner[-1]), np.uint32)
        wider[places[~inner]] = out[~inner]
        pairs = rules[out[inner] - FIRST_RULE]
        wider[places[inner]], wider[places[inner] + 1] = pairs[:, 0], pairs[:, 1]
        out = wider


def expand_all(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same for all symbols of a shard: every rule is spelled out once, level by level, where that is not much."""
    if not len(rules) or int(lengths.sum()) > SPELLED:
        return expand(symbols, rules)
    # An id is spelled by itself, the rules stand behind all ids.
    sizes = np.append(np.ones(FIRST_RULE, np.int64), lengths)
    starts = np.cumsum(sizes) - sizes
    flat = np.empty(FIRST_RULE + int(lengths.sum()), np.uint32)
    flat[:FIRST_RULE] = np.arange(FIRST_RULE, dtype=np.uint32)
    for level in _levels(rules):
        ends = np.cumsum(lengths[level])
        places = np.repeat(starts[level + FIRST_RULE] - (ends - lengths[level]), lengths[level]) + np.arange(int(ends[-1]))
        flat[places] = _spelled(rules[level].ravel(), starts, sizes, flat)
    return _spelled(symbols, starts, sizes, flat)


class Shard:
    """One stored shard: documents by position, decoded on demand."""

    def __init__(self, data: bytes):
        magic, docs, rules, symbols = struct.unpack_from("<4sIIQ", data)
        if magic != _MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize("<4sIIQ")
        fields = []
        for kind, n in ((np.int64, docs), (np.int64, docs), (np.int64, docs), (np.uint32, 2 * rules), (np.int64, rules), (np.uint32, symbols)):
            fields.append(np.frombuffer(data, kind, n, at))
            at += fields[-1].nbytes
        self.doc_ids, self.id_ends, self.symbol_ends, flat, self.lengths, self.symbols = fields
        self.rules = flat.reshape(-1, 2)

    def all_ids(self) -> np.ndarray:
        return expand_all(self.symbols, self.rules, self.lengths)

    def document(self, k: int) -> np.ndarray:
        start = self.symbol_ends[k - 1] if k else 0
        return expand(self.symbols[start : self.symbol_ends[k]], self.rules)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the shard; only the symbols that cover them are expanded."""
        inner = self.symbols >= FIRST_RULE
        sizes = np.ones(len(self.symbols), np.int64)
        sizes[inner] = self.lengths[self.symbols[inner] - FIRST_RULE]
        edges = np.cumsum(sizes)
        first, last = np.searchsorted(edges, start, "right"), np.searchsorted(edges, stop, "left") + 1
        begin = int(edges[first - 1]) if first else 0
        return expand(self.symbols[first:last], self.rules)[start - begin : stop - begin]


def pack(doc_ids: Sequence[int], ids: np.ndarray, ends: np.ndarray) -> bytes:
    rules, symbols, symbol_ends = compress(ids, ends)
    head = struct.pack("<4sIIQ", _MAGIC, len(doc_ids), len(rules), len(symbols))
    arrays = [np.asarray(doc_ids, np.int64), ends.astype(np.int64), symbol_ends.astype(np.int64), rules, expansion_lengths(rules), symbols]
    return head + b"".join(a.tobytes() for a in arrays)


# ---------------------------------------------------------------- encoding

_LETTER, _DIGIT, _BLANK, _OTHER = 0, 1, 2, 3
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[97:123] = _KIND[128:] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _BLANK
_KINDS = _KIND.tobytes()
# Characters whose lower case and composed form are one plain letter, and ASCII without the apostrophe (contractions).
_PLAIN = {chr(c) for c in range(128)} - {"'"} | {chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha() and c != 0x130}
_NOT_PLAIN = re.compile(f"[^{re.escape(''.join(sorted(_PLAIN)))}]")


# Byte-level tokenizers write a byte that is no visible Latin-1 sign as the next character from U+0100 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELLED = np.arange(256, dtype="<u2")
_SPELLED[[b for b in range(256) if b not in _VISIBLE]] = np.arange(0x100, 0x200 - len(_VISIBLE))
_SPELLED[10] = 10  # in no word, between words here
_CONTROL = np.isin(np.arange(256), [*range(10), *range(11, 32), 127])

# How a tokenizer must normalise and cut texts so that its words can be encoded one by one.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_CUT = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class _Numbers:
    """Numbers of 64-bit hashes, looked up many at a time: the hash's first bits say where to look, else one place on."""

    def __init__(self, most: int):
        self.bits = max(4, (2 * most).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.numbers = np.full(1 << self.bits, -1, np.int32)
        self.size = 0

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it has none."""
        spots = self._home(hashes)
        out = self.numbers[spots]
        todo = np.flatnonzero((self.keys[spots] != hashes) & (out >= 0))
        while len(todo):
            spots[todo] = (spots[todo] + 1) & (len(self.keys) - 1)
            out[todo] = self.numbers[spots[todo]]
            todo = todo[(self.keys[spots[todo]] != hashes[todo]) & (out[todo] >= 0)]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number new hashes, all different, on from the last number."""
        numbers = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        spots, todo = self._home(hashes), np.arange(len(hashes))
        while len(todo):
            free = todo[self.numbers[spots[todo]] < 0]
            self.numbers[spots[free]] = numbers[free]  # of several that want one place, one gets it
            won = free[self.numbers[spots[free]] == numbers[free]]
            self.keys[spots[won]] = hashes[won]
            todo = todo[self.numbers[spots[todo]] != numbers[todo]]
            spots[todo] = (spots[todo] + 1) & (len(self.keys) - 1)


def _grown(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` after its first ``used`` entries; room is doubled where it ends."""
    if used + len(more) > len(held):
        held = np.concatenate([held[:used], np.empty(max(used, len(more)), held.dtype)])
    held[used : used + len(more)] = more
    return held


class WordEncoder:
    """The library's encoding, with every distinct word encoded once.

    The tokenizer lower-cases, drops white space and cuts a text into runs of letters, single digits and runs of other
    signs before it looks at pairs, so a text's ids are those of its words in a row. Texts with characters for which
    that cut is not plain are given to the library whole, and so are all texts of a tokenizer that cuts in another way.
    The library stays on the one core that Spark gives the task.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        model = spec["model"]
        self.by_words = (
            spec["normalizer"] == _NORMALIZER
            and spec["pre_tokenizer"] == _CUT
            and model["type"] == "BPE"
            and not model["dropout"]
            and all(t["content"].startswith("<|") for t in spec["added_tokens"])
        )
        self._reset()

    def _reset(self, most: int = KNOWN_WORDS) -> None:
        self.known, self.most, self.n_ids = _Numbers(most), most, 0
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def _words(self, buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the lower-cased words between these places of a UTF-8 buffer, one word after another, and their numbers.

        Nothing before the model changes letters or visible signs but for their spelling in byte characters, so words go
        to the model in that spelling; words with control characters take the whole way.
        """
        spelled = self.tokenizer.model.tokenize
        ends = np.cumsum(stops - starts + 1)
        where = np.repeat(stops + 1 - ends, stops - starts + 1) + np.arange(ends[-1])
        letters = buffer.take(where, mode="clip")
        letters[ends - 1] = 10
        words = _SPELLED[letters[:-1]].tobytes().decode("utf-16-le").split("\n")
        other = np.unique(np.searchsorted(ends, np.flatnonzero(_CONTROL[letters]), "right")).tolist()
        found = [[t.id for t in spelled(word)] for word in words]
        texts = [buffer[starts[k] : stops[k]].tobytes().decode() for k in other]
        for k, whole in zip(other, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            found[k] = whole.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _learn(self, hashes: np.ndarray, buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        ids, sizes = self._words(buffer, starts, stops)
        first, upto = self.known.size, np.cumsum(sizes)
        self.known.add(hashes)
        self.starts = _grown(self.starts, first, self.n_ids + upto - sizes)
        self.sizes = _grown(self.sizes, first, sizes.astype(np.int32))
        self.ids = _grown(self.ids, self.n_ids, ids)
        self.n_ids += len(ids)

    def _buffer(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words in a buffer, where each word starts, and its number of ids."""
        buffer = np.frombuffer(data, np.uint8)
        kind = np.frombuffer(data.translate(_KINDS), np.uint8)
        cut = np.ones(len(buffer), bool)
        cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        real = kind != _BLANK
        starts, stops = np.flatnonzero(cut & real), np.flatnonzero(cut[1:] & real[:-1]) + 1
        if len(starts) > len(stops):  # the last word ends with the buffer
            stops = np.append(stops, len(buffer))
        hashes = bounds_hash(buffer, starts, stops)
        numbers = self.known.find(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            if self.known.size + len(missing) > self.most:
                self._reset(max(KNOWN_WORDS, len(hashes)))
                missing = np.arange(len(hashes))
            fresh, first = np.unique(hashes[missing], return_index=True)
            self._learn(fresh, buffer, starts[missing[first]], stops[missing[first]])
            numbers[missing] = self.known.find(hashes[missing])
        sizes = self.sizes[numbers]
        total = np.cumsum(sizes, dtype=np.int64)
        where = np.repeat(self.starts[numbers] - (total - sizes), sizes)
        where += np.arange(len(where))
        return self.ids[where], starts, sizes

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, special tokens not added."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        plain, other = [], []
        for number, text in enumerate(texts):
            ok = self.by_words and "<|" not in text and ("'" not in text if text.isascii() else not _NOT_PLAIN.search(text))
            (plain if ok else other).append(number)
        for number, encoded in zip(other, self.tokenizer.encode_batch([texts[k] for k in other], add_special_tokens=False), strict=True):
            out[number].append(np.array(encoded.ids, np.uint32))
        for data, ends in buffers([texts[k].lower().encode() for k in plain], IS_SPACE, b" "):
            if len(data) > CHUNK:  # one word longer than a buffer
                for number in {n for n, _ in ends}:
                    ids = self.tokenizer.encode(data.decode(), add_special_tokens=False).ids
                    out[plain[number]].append(np.array(ids, np.uint32))
                continue
            ids, starts, sizes = self._buffer(data)
            edges = np.append(0, np.cumsum(sizes))[np.searchsorted(starts, [end for _, end in ends])]
            for (number, _), a, b in zip(ends, np.append(0, edges[:-1]), edges, strict=True):
                out[plain[number]].append(ids[a:b])
        return [np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint32) for parts in out]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so words learned in one task serve the next."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- files

SHARD_ROWS = "range int, part int, first_id long, last_id long, n_ids long, payload binary"
_SHARDS = pa.schema(
    [
        ("range", pa.int32()),
        ("part", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("n_ids", pa.int64()),
        ("payload", pa.binary()),
    ]
)
LATE = (1 << 63) - 1  # stands for a null doc_id


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write their shards to ``path``.

    Documents are dealt out by ranges of doc_id, nulls last, and rows of one doc_id by the hash of their text, so a
    repeated or missing id that holds much of the table is spread too. Files in the order of their names, shards in
    them and documents in these ascend by doc_id; a shard ends at two million ids or with its range. Null texts are
    empty; every document ends with ``end_id``, so an empty one is that id alone. An empty table writes no shard. The
    greatest long stands for null and cannot be a doc_id.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        place, part, size = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int] = []
        held: list[np.ndarray] = []

        def shard() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in held])
            payload = pack(doc_ids, np.concatenate(held), ends)
            row = [place, part, doc_ids[0], doc_ids[-1], size, payload]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARDS, strict=True)], schema=_SHARDS)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pydict()
                for doc_id, ids in zip(rows["doc_id"], encoder.encode(rows["text"]), strict=True):
                    if size >= SHARD_IDS:
                        yield shard()
                        part, size, doc_ids, held = part + 1, 0, [], []
                    doc_ids.append(doc_id)
                    held.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
        if held:
            yield shard()

    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(LATE)).alias("doc_id")
    rows = docs.select(doc_id, text_or_empty().alias("text"))
    order = ("doc_id", "_hash")
    ordered = rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    shards = ordered.select("doc_id", "text").mapInArrow(task, SHARD_ROWS)
    shards.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_documents(shards: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every stored document, from its ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, part, data in zip(*(batch.column(k) for k in ("range", "part", "payload")), strict=True):
                shard = Shard(data.as_py())
                ids = shard.all_ids().astype("<u4")
                ends = shard.id_ends.tolist()
                begins = [0, *ends[:-1]]
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([place.as_py()] * n, pa.int32()),
                        pa.array([part.as_py()] * n, pa.int32()),
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(begins, pa.int64()),
                        pa.array(np.diff(shard.id_ends, prepend=0), pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["range", "part", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    schema = "range int, part int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    documents = shards.select("range", "part", "payload").mapInArrow(task, schema)
    keys = ["range", "part"]
    starts = running_total(shards.select(*keys, "n_ids"), keys, "n_ids", "before", work, "starts").drop("n_ids")
    return documents.join(starts, keys).select(
        F.when(F.col("doc_id") != LATE, F.col("doc_id")).alias("doc_id"),
        (F.col("before") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def ids_of(shards: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id and ids of a few documents: only shards that may hold one are read, and of them only those documents.

    A doc_id that is stored several times gives several rows, one that is not stored gives none.
    """
    wanted = np.unique(np.array(list(doc_ids), np.int64))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("payload"):
                shard = Shard(data.as_py())
                places = np.flatnonzero(np.isin(shard.doc_ids, wanted)).tolist()
                ids = pa.array([shard.document(k).astype(np.int32) for k in places], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[places], pa.int64()), ids], ["doc_id", "ids"])

    if not len(wanted):
        return shards.sparkSession.createDataFrame([], "doc_id long, ids array<int>")
    near = shards.where((F.col("first_id") <= int(wanted[-1])) & (F.col("last_id") >= int(wanted[0])))
    holds = F.exists(F.lit(wanted.tolist()), lambda i: i.between(F.col("first_id"), F.col("last_id")))
    return near.where(holds).select("payload").mapInArrow(task, "doc_id long, ids array<int>")
