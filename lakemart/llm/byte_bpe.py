"""Byte-level BPE by prefix-sharing trie traversal, and its decoding.

The last token of a prefix settles the encoding of the prefix: what lies before that token is again an encoded prefix.
So the distinct words of a batch form a trie, laid out as sorted words with the length each shares with the word
before it. One depth-first walk carries the last token of every prefix on the current path; a prefix that many words
share is worked out once. A word's ids are read back from its end, token by token.

A token t may follow a token s when merging never crosses their border. Every token has one way of being merged, so
only the tokens at the right edge of s and at the left edge of t meet there, each for as long as it is the outermost.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.tables import text_or_empty

KNOWN_WORDS, KNOWN_IDS, KNOWN_PAIRS, LONG_WORD = 1 << 18, 1 << 21, 1 << 19, 64
SLICE_CHARS = 1 << 21
_NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._check(spec)
        letters, model = byte_letters(), spec["model"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelled = {t: i for t, i in model["vocab"].items() if t not in special}
        self.ids = {bytes(letters[c] for c in t): i for t, i in spelled.items()}
        self.special = special
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in special.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {(spelled[a], spelled[b]): r for r, (a, b) in enumerate(pairs)}
        made: dict[int, tuple[int, int, int]] = {}
        for (a, b), rank in self.rank.items():
            made.setdefault(self.ids[self.bytes[a] + self.bytes[b]], (rank, a, b))
        self.right = {i: self._edge(i, made, 2) for i in self.ids.values()}
        self.left = {i: self._edge(i, made, 1) for i in self.ids.values()}
        self.before, self.ending = self._endings()
        self.pairs: dict[int, bool] = {}

    def _endings(self) -> tuple[dict[int, int], list[int]]:
        """A trie of the tokens read from their ends: (node, byte) to node, and the token that a node completes or -1."""
        before: dict[int, int] = {}
        ending = [-1]
        for token, number in self.ids.items():
            node = 0
            for byte in reversed(token):
                node = before.setdefault(node << 8 | byte, len(ending))
                if node == len(ending):
                    ending.append(-1)
            ending[node] = number
        return before, ending

    @staticmethod
    def _check(spec: dict) -> None:
        cut, model = spec["pre_tokenizer"] or {}, spec["model"]
        wanted = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        bare = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
        if spec["normalizer"] or model["type"] != "BPE" or not (wanted and plain and bare):
            raise ValueError("not a plain byte-level BPE tokenizer")

    @staticmethod
    def _edge(token: int, made: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, int, int]]:
        """(token, rank that makes it, rank that ends it) of the tokens at one edge while ``token`` comes about."""
        out, until = [], _NEVER
        while token in made:
            out.append((token, made[token][0], until))
            until, token = made[token][0], made[token][side]
        out.append((token, -1, until))
        return out

    def follows(self, before: int, token: int) -> bool:
        """Whether the bytes of both tokens, side by side, encode to just these two.

        Of equal merges the one further left is done first: the own merge of the left token wins a tie with one
        across the border, that of the right token loses it.
        """
        if len(self.pairs) >= KNOWN_PAIRS:
            self.pairs.clear()
        free = self.pairs[before << 32 | token] = not self._crossed(self.right[before], self.left[token])
        return free

    def _crossed(self, right: list[tuple[int, int, int]], left: list[tuple[int, int, int]]) -> bool:
        a, b = len(right) - 1, len(left) - 1
        while a >= 0 and b >= 0:
            (x, _, x_ends), (y, _, y_ends) = right[a], left[b]
            merge = self.rank.get((x, y), _NEVER)
            if merge < x_ends and merge <= y_ends and merge != _NEVER:
                return True
            a, b = (a - 1, b) if x_ends <= y_ends else (a, b - 1)
        return False


def shared_lengths(words: Sequence[bytes]) -> list[int]:
    """For sorted words, how many first bytes each has in common with the word before it."""
    out, before = [], b""
    for word in words:
        n, most = 0, min(len(word), len(before))
        if word[:most] == before[:most]:
            n = most
        else:
            while word[n] == before[n]:
                n += 1
        out.append(n)
        before = word
    return out


def encode_words(words: Sequence[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each of the sorted distinct words, by one depth-first walk over their trie."""
    before, ending, pairs, follows = vocabulary.before, vocabulary.ending, vocabulary.pairs, vocabulary.follows
    last: list[int] = [-1]  # last token of each prefix of the current path
    start: list[int] = [0]  # where that token starts
    out = []
    for word, depth in zip(words, shared_lengths(words), strict=True):
        del last[depth + 1 :], start[depth + 1 :]
        for end in range(depth, len(word)):
            node, begin = 0, end
            while True:
                node = before[node << 8 | word[begin]]
                token = ending[node]
                if token >= 0:
                    if not begin:
                        break
                    free = pairs.get(last[begin] << 32 | token)
                    if follows(last[begin], token) if free is None else free:
                        break
                begin -= 1
            last.append(token)
            start.append(begin)
        found, end = [], len(word)
        while end:
            found.append(last[end])
            end = start[end]
        found.reverse()
        out.append(found)
    return out


# ---------------------------------------------------------------- whole texts

# Characters whose class (letter, number, white space, other) no Unicode version changes: ASCII, Latin-1, Latin Extended-A.
_PLAIN = re.compile("[\x00-ſ]*")
_LETTERS, _NUMBERS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_CUT = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)


class Encoder:
    """Encodes texts as the tokenizers library does with the same file; words seen before are not walked again.

    A text is first cut at special tokens, then into words: by one pattern where all its characters are plain, else by
    the library's own cutter, so that both agree on what a letter is. What is remembered is bounded by number and
    bytes of the words; words of more than ``LONG_WORD`` characters are never remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        library = Tokenizer.from_file(path)
        self._cutter, self._letters = library.pre_tokenizer, byte_letters()
        parts = "|".join(re.escape(t) for t in sorted(self.vocabulary.special, key=len, reverse=True))
        self._special = re.compile(f"({parts})") if parts else None
        self._known: dict[str, int] = {}
        self._ids = np.empty(0, np.int32)
        self._ends = np.zeros(1, np.int64)

    def _words(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _CUT.findall(text)
        letters = self._letters
        cut = self._cutter.pre_tokenize_str(text)
        return [bytes(letters[c] for c in word).decode("utf-8", "surrogateescape") for word, _ in cut]

    def _cut(self, text: str) -> list[str | int]:
        """Words, and ids of special tokens."""
        if self._special is None or not self._special.search(text):
            return self._words(text)
        out: list[str | int] = []
        for k, part in enumerate(self._special.split(text)):
            out.extend([self.vocabulary.special[part]] if k % 2 else self._words(part))
        return out

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids end."""
        cut = [self._cut(t) for t in texts]
        known, first = self._known, len(self._ends) - 1
        fresh = {w for words in cut for w in words if w not in known}
        spelled = sorted((w.encode("utf-8", "surrogateescape"), w) for w in fresh if isinstance(w, str))
        found = encode_words([s for s, _ in spelled], self.vocabulary)
        names = [w for _, w in spelled]
        for token in self.vocabulary.special.values():
            names.append(token)
            found.append([token])
        place = {w: first + k for k, w in enumerate(names)}
        lengths = np.array([len(f) for f in found], np.int64)
        ids = np.concatenate([self._ids, np.array([i for f in found for i in f], np.int32)])
        ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(lengths)])
        flat = [known[w] if w in known else place[w] for words in cut for w in words]
        numbers = np.array(flat, np.int64)
        sizes = ends[numbers + 1] - ends[numbers]
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(upto) else 0
        out = ids[np.repeat(ends[numbers] - (upto - sizes), sizes) + np.arange(total)]
        words_upto = np.cumsum([len(words) for words in cut]).astype(np.int64)
        self._remember(names[: len(spelled)], found)
        return out, np.concatenate([[0], upto])[words_upto] if len(cut) else words_upto

    def _remember(self, words: list[str], found: list[list[int]]) -> None:
        """Add short words while there is room; the frequent ones come early."""
        ids, ends, at = [], [], int(self._ends[-1])
        for word, own in zip(words, found, strict=False):
            if len(self._known) >= KNOWN_WORDS or at >= KNOWN_IDS:
                break
            if len(word) <= LONG_WORD:
                self._known[word] = len(self._known)
                ids += own
                at += len(own)
                ends.append(at)
        self._ids = np.concatenate([self._ids, np.array(ids, np.int32)])
        self._ends = np.concatenate([self._ends, np.array(ends, np.int64)])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, ids beyond the vocabulary nothing."""
        of = self.vocabulary.bytes
        return b"".join([of.get(i, b"") for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(t) for t in batch.column("text").to_pylist()], np.int64)
    edges, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = int(edges[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(edges, done + SLICE_CHARS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _with_ids(path: str, batch: pa.RecordBatch, decoded: bool) -> pa.RecordBatch:
    encoder = _encoder(path)
    ids, ends = encoder.encode(batch.column("text").to_pylist())
    edges = np.concatenate([[0], ends]).astype(np.int32)
    columns = {"row": batch.column("row"), "ids": pa.ListArray.from_arrays(pa.array(edges), pa.array(ids))}
    if decoded:
        texts = [encoder.decode(ids[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        columns["decoded"] = pa.array(texts, pa.string())
    return pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, path: str, carry: Sequence[str] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """The columns of ``carry`` with ``ids`` (array of int), and with ``decoded`` also the text that the ids give back.

    Special tokens in a text become their ids, as in the library's default. A null text is empty, and an empty text has
    no ids. Every row is encoded by itself: repeated rows and null or repeated doc_ids come out as they went in, an
    empty table gives no rows, other columns are not read; ``carry`` cannot hold ``ids`` or ``decoded``. Whole texts
    are encoded, in one walk for all words of a slice of rows; a very long text is a slice of its own.
    """
    rows = docs.select(F.struct(*carry).alias("row"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _text_slices(batch):
                yield _with_ids(path, piece, decoded)

    row = rows.schema["row"].dataType.simpleString()
    schema = f"row {row}, ids array<int>" + (", decoded string" if decoded else "")
    return rows.mapInArrow(run, schema).select("row.*", "ids", *(["decoded"] if decoded else []))


def decode(encoded: DataFrame, path: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns of ``carry`` and ``text``, the text of ``ids``; null ids give an empty text."""
    rows = encoded.select(F.struct(*carry).alias("row"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_encoder(path).decode(i.values.to_numpy(zero_copy_only=False).tolist()) for i in batch.column("ids")]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "text": pa.array(texts, pa.string())})

    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, text string").select("row.*", "text")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
