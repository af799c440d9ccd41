"""SentencePiece encoding and decoding with exact n-best segmentations.

The lattice of a text holds every piece of the vocabulary that matches somewhere, and the single bytes of characters
that no piece covers. Forward Viterbi gives the best score of every prefix; these scores are the exact remaining cost
of a backward search, so an A* search from the end of the text pops complete segmentations in order of score.

The lattice falls apart wherever no piece of the vocabulary holds the two neighbouring characters. Equal chunks are
searched once per batch, short ones are remembered while there is room, and the n best segmentations of a text follow
from the n best of its chunks. Scores are whole numbers (2**-20 of a nat), so sums are exact and ties are ties.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.hashing import mix
from lakemart.llm.held import held
from lakemart.llm.tables import text_or_empty

N_BEST = 4
SPACE = "▁"
_LITERAL = "\U0010fffe"  # stands for U+2581 in a text, so that it is spelled in bytes and not read as a blank
BATCH_CHARS = 1 << 17
UNIT = 1 << 20
KNOWN_CHUNKS, KNOWN_IDS, LONG_CHUNK = 1 << 19, 1 << 24, 48


class Pieces:
    """A vocabulary with scores.

    The model's own scores are merge ranks; as log-probabilities the pieces get Zipf's law on the same ranks
    (-ln(rank + 2.7), normalised). A byte costs as much as the rarest piece and one more.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes = [0] * 256
        self.surface: list[bytes] = [b""] * size
        plain: list[tuple[int, str]] = []
        for number in range(size):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                value = int(piece[3:-1], 16)
                self.bytes[value], self.surface[number] = number, bytes([value])
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                plain.append((number, piece))
                self.surface[number] = piece.replace(SPACE, " ").encode()
        weights = 1 / (np.arange(len(plain)) + 2.7)
        logs = np.log(weights / weights.sum())
        scores = np.rint(logs * UNIT).astype(np.int64).tolist()
        self.pieces = {piece: (number, score) for (number, piece), score in zip(plain, scores, strict=True)}
        self.byte_score = scores[-1] - UNIT
        self.backwards: dict = {}  # trie of the pieces from their last character on; "" leads to (id, score)
        for piece, found in self.pieces.items():
            node = self.backwards
            for char in reversed(piece):
                node = node.setdefault(char, {})
            node[""] = found
        self._joins([piece for _, piece in plain])
        self.widths = np.array([len(b) for b in self.surface], np.int64)
        self.offsets = np.cumsum(self.widths) - self.widths
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)

    def _joins(self, pieces: list[str]) -> None:
        """Which characters stand next to each other inside some piece."""
        pairs = {(a, b) for piece in pieces for a, b in itertools.pairwise(piece)}
        alphabet = sorted({c for pair in pairs for c in pair})
        place = {c: k + 1 for k, c in enumerate(alphabet)}
        self.place = np.zeros(0x110000, np.int16)
        for c, k in place.items():
            self.place[ord(c)] = k
        self.joined = np.zeros((len(alphabet) + 1, len(alphabet) + 1), bool)
        for a, b in pairs:
            self.joined[place[a], place[b]] = True

    def edges(self, text: str, end: int) -> list[tuple[int, int, tuple[int, ...]]]:
        """(start, score, ids) of everything in the lattice that ends at ``end``."""
        out, node, start = [], self.backwards, end
        while start:
            start -= 1
            node = node.get(text[start])
            if node is None:
                break
            found = node.get("")
            if found is not None:
                out.append((start, found[1], (found[0],)))
        char = text[end - 1]
        if char not in self.pieces:
            data = (SPACE if char == _LITERAL else char).encode()
            out.append((end - 1, self.byte_score * len(data), tuple(self.bytes[b] for b in data)))
        return out

    def n_best(self, text: str, n: int = N_BEST) -> list[tuple[int, tuple[int, ...]]]:
        """The n best segmentations of a text, best first; of equal scores, those the search completes first.

        Hypotheses are chains that share their ends, and among equal ones the search goes on with the longest, so a
        text that many segmentations fit equally well takes time and memory in proportion to its length.
        """
        best, into = [0], [[]]
        for end in range(1, len(text) + 1):
            edges = self.edges(text, end)
            into.append(edges)
            top = None
            for start, score, _ in edges:
                score += best[start]
                if top is None or score > top:
                    top = score
            best.append(top)
        serial, push, pop = 0, heapq.heappush, heapq.heappop
        heap: list[tuple[int, int, int, int, tuple | None]] = [(-best[-1], len(text), 0, 0, None)]
        out = []
        while heap:
            _, end, _, after, chain = pop(heap)
            if not end:
                ids: list[int] = []
                while chain:
                    ids += chain[0]
                    chain = chain[1]
                out.append((after, tuple(ids)))
                if len(out) == n:
                    break
                continue
            for start, score, own in into[end]:
                serial += 1
                total = after + score
                push(heap, (-best[start] - total, start, serial, total, (own, chain)))
        return out

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """True where a chunk begins: no piece holds the character and the one before."""
        places = self.place[codes]
        out = np.ones(len(codes), bool)
        out[1:] = ~self.joined[places[:-1], places[1:]]
        return out


class Segmenter:
    """n-best segmentation of texts.

    Segmentation k of chunk c is entry ``c * width + k`` of flat arrays, so an id list is a row of entries and all lists
    of a batch are put together in one step. What is remembered is bounded by number and ids of the chunks.
    """

    def __init__(self, path: str, n: int = N_BEST, others: bool = True):
        self.pieces, self.n, self.others = Pieces(path), n, others
        self.width = n if others else 1
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)  # of the entries; the first entry starts at 0
        self.scores, self.losses = np.zeros(0, np.int64), np.zeros((0, n - 1))

    def _search(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """ids, sizes of the entries, scores and losses (of the 2nd to n-th best against the best) of new chunks."""
        found = [self.pieces.n_best(chunk, self.n) for chunk in chunks]
        losses = np.full((len(found), self.n - 1), np.inf)
        sizes = np.zeros((len(found), self.width), np.int64)
        ids: list[int] = []
        for k, variants in enumerate(found):
            for j, (score, own) in enumerate(variants):
                if j:
                    losses[k, j - 1] = variants[0][0] - score
                if j < self.width:
                    sizes[k, j] = len(own)
                    ids += own
        scores = np.array([v[0][0] for v in found], np.int64)
        return np.array(ids, np.int32), sizes.ravel(), scores, losses

    def _remember(self, chunks: list[str], first: int, ends: np.ndarray, arrays: tuple) -> None:
        """Keep the short ones among the new chunks while there is room; the frequent ones come early."""
        ids, scores, losses = arrays
        kept = [k for k, chunk in enumerate(chunks) if len(chunk) <= LONG_CHUNK]
        room = min(KNOWN_CHUNKS - len(self.known), KNOWN_CHUNKS if len(self.ids) < KNOWN_IDS else 0)
        kept = kept[: max(0, room)]
        if not kept:
            return
        for k in kept:
            self.known[chunks[k]] = len(self.known)
        entries = (np.array(kept)[:, None] * self.width + np.arange(self.width) + first * self.width).ravel()
        sizes = ends[entries + 1] - ends[entries]
        self.ids = np.concatenate([self.ids, ids[_ranges(ends[entries], sizes)]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        chosen = np.array(kept) + first
        self.scores = np.concatenate([self.scores, scores[chosen]])
        self.losses = np.concatenate([self.losses, losses[chosen]])

    def _distinct(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct chunks of a text, which of them every chunk is, and where the chunks begin.

        Chunks are told apart by hashes, and then every chunk is compared with the one that its hash stands for.
        """
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts = np.flatnonzero(self.pieces.cuts(codes))
        sizes = np.diff(starts, append=len(codes))
        inside = np.arange(len(codes)) - np.repeat(starts, sizes)
        parts = mix((codes.astype(np.uint64) << np.uint64(32)) | inside.astype(np.uint64))
        sums = mix(np.add.reduceat(parts, starts) + sizes.astype(np.uint64))
        _, first, inverse = np.unique(sums, return_index=True, return_inverse=True)
        same = (sizes[first][inverse] == sizes).all()
        if not (same and (codes[np.repeat(starts[first][inverse], sizes) + inside] == codes).all()):
            names = [text[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
            place = {name: k for k, name in enumerate(dict.fromkeys(names))}
            return list(place), np.array([place[name] for name in names], np.int64), starts
        stops = starts + sizes
        return [text[starts[f] : stops[f]] for f in first.tolist()], inverse, starts

    def _best_of(self, scores: np.ndarray, losses: np.ndarray) -> tuple[list[float], list[tuple[tuple[int, int], ...]]]:
        """Scores of the n best, and for each which chunks (by position) use which variant instead of their best.

        Only the n - 1 smallest single losses can occur in them, so all sums of those are enough.
        """
        base = int(scores.sum())
        losses = losses.ravel()
        few = min(self.n - 1, len(losses))
        chosen = np.sort(np.argpartition(losses, few - 1)[:few]) if few else np.empty(0, np.int64)
        single = [(float(losses[k]), (int(k) // (self.n - 1), int(k) % (self.n - 1) + 1)) for k in chosen if losses[k] < np.inf]
        options = []
        for r in range(len(single) + 1):
            for group in itertools.combinations(single, r):
                if len({place for _, (place, _) in group}) == r:
                    options.append((sum(loss for loss, _ in group), tuple(change for _, change in group)))
        options.sort()
        return [(base - loss) / UNIT for loss, _ in options[: self.n]], [changes for _, changes in options[: self.n]]

    def batches(self, texts: Sequence[str]) -> Iterator[tuple[list[list[float]], np.ndarray, np.ndarray]]:
        """For so many texts at a time: the scores of each, all id lists in a row, and where each list ends.

        A text has as many lists as scores if others are wanted, else one; an empty text has one empty list.
        """
        marked = [SPACE + t.replace(SPACE, _LITERAL).replace(" ", SPACE) if t else "" for t in texts]
        at = 0
        while at < len(marked):
            upto, size = at, 0
            while upto < len(marked) and (upto == at or size + len(marked[upto]) <= BATCH_CHARS):
                size += len(marked[upto])
                upto += 1
            yield self._batch(marked[at:upto])
            at = upto

    def segment(self, texts: Sequence[str]) -> Iterator[tuple[np.ndarray, list[float], list[np.ndarray]]]:
        """(best ids, scores of the n best, all n id lists) per text; an empty text has one empty segmentation."""
        for scores, ids, ends in self.batches(texts):
            lists = iter(np.split(ids, ends[:-1]))
            for own in scores:
                found = [next(lists) for _ in range(len(own) if self.others else 1)]
                yield found[0], own, found

    def _batch(self, texts: list[str]) -> tuple[list[list[float]], np.ndarray, np.ndarray]:
        # U+10FFFF, a character that no piece holds, keeps the texts apart and is itself a chunk
        chunks, inverse, starts = self._distinct("\U0010ffff".join([*texts, ""]))
        known = np.array([self.known.get(chunk, -1) for chunk in chunks], np.int64)
        told = known >= 0
        fresh = [chunks[k] for k in np.flatnonzero(~told).tolist()]
        # Of what is remembered, only the chunks of this batch are copied; the new ones follow them.
        old = known[told]
        entries = (old[:, None] * self.width + np.arange(self.width)).ravel()
        old_sizes = self.ends[entries + 1] - self.ends[entries]
        new_ids, new_sizes, new_scores, new_losses = self._search(fresh)
        ids = np.concatenate([self.ids[_ranges(self.ends[entries], old_sizes)], new_ids])
        ends = np.append(0, np.cumsum(np.concatenate([old_sizes, new_sizes])))
        all_scores = np.concatenate([self.scores[old], new_scores])
        losses = np.concatenate([self.losses[old], new_losses])
        numbers = np.where(told, np.cumsum(told) - 1, len(old) + np.cumsum(~told) - 1)[inverse]

        stops = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]) - 1).tolist()
        found, rows, lengths, at = [], [], [], 0
        for stop in stops:
            own = numbers[at:stop]
            at = stop + 1
            scores, changes = self._best_of(all_scores[own], losses[own])
            found.append(scores)
            for change in changes if self.others else changes[:1]:
                row = own * self.width
                for where, variant in change:
                    row[where] += variant
                rows.append(row)
                lengths.append(len(row))
        entries = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        sizes = ends[entries + 1] - ends[entries]
        upto = np.append(0, np.cumsum(sizes))
        out = ids[_ranges(ends[entries], sizes)]
        self._remember(fresh, len(old), ends, (ids, all_scores, losses))
        return found, out, upto[np.cumsum(lengths, dtype=np.int64)]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, ``sizes`` of them, in a row."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(int(total[-1]) if len(total) else 0)


def decode(ids: Sequence[int], surface: Sequence[bytes]) -> str:
    """The text of a list of ids: their surfaces in a row, without the blank that encoding puts in front."""
    return b"".join(map(surface.__getitem__, ids))[1:].decode("utf-8", "replace")


def decode_lists(ids: np.ndarray, ends: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The same for many id lists in a row, as UTF-8."""
    widths = pieces.widths[ids]
    data = pieces.flat[_ranges(pieces.offsets[ids], widths)].tobytes()
    edges = np.append(0, np.cumsum(widths))[np.append(0, ends)].tolist()
    return [data[a + 1 : b] for a, b in itertools.pairwise(edges)]


def segmenter(path: str, n: int = N_BEST, others: bool = False) -> Segmenter:
    """One per Python worker, so chunks found in one task serve the next; another operator's tasks drop it."""
    return held(("segmenter", path, n, others), lambda: Segmenter(path, n, others))


_ENCODED = [("ids", pa.list_(pa.int32())), ("scores", pa.list_(pa.float64())), ("others", pa.list_(pa.list_(pa.int32())))]


def encode(docs: DataFrame, path: str, n: int = N_BEST, others: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, ids (of the best segmentation), scores (of the n best) and, if wanted, the other n - 1 id lists.

    One row per row of ``docs`` (doc_id, text, and the columns named in ``carry``). A null or empty text has no ids
    and the one score 0; a text with fewer than n segmentations has as many scores as it has segmentations. Every
    other text decodes exactly. Equal scores are ordered by the places they differ in. An empty table gives no rows;
    other columns are ignored.
    """
    names = ["doc_id", *carry, "text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(path, n, others)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = list(own.segment(part.column("text").to_pylist()))
                ids = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum([len(f[0]) for f in found])), pa.int32()),
                    pa.array(np.concatenate([f[0] for f in found]), pa.int32()),
                )
                scores = pa.array([f[1] for f in found], _ENCODED[1][1])
                lists = [x for f in found for x in f[2][1:]]
                inner = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum([len(x) for x in lists], dtype=np.int64)), pa.int32()),
                    pa.array(np.concatenate([np.zeros(0, np.int32), *lists]), pa.int32()),
                )
                rest = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum([len(f[2]) - 1 for f in found])), pa.int32()), inner
                )
                columns = [part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays([*columns, ids, scores, rest], [*names, *[f[0] for f in _ENCODED]])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, text_or_empty().alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(task, f"{kinds}, ids array<int>, scores array<double>, others array<array<int>>")


_DIGESTED = "doc_id long, scores array<double>, lengths array<long>, crc32s array<long>, round_trips array<boolean>"


def digests(docs: DataFrame, path: str, n: int = N_BEST) -> DataFrame:
    """Per row of ``docs``: n_pieces, ids_crc32, scores of the best, second and last segmentation, whether ids decode exactly.

    All n id lists are made, decoded and compared with the text where they are made, so none of them leaves its task.
    n_lists counts them, the best first; lengths, crc32s and round_trips have one entry for each. Odd rows are those of
    ``encode``.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(path, n, True)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                columns: dict[str, list] = {"scores": [], "lengths": [], "crc32s": [], "round_trips": []}
                done = 0
                for scores, ids, ends in own.batches(texts):
                    read = decode_lists(ids, ends, own.pieces)
                    small = ids.astype("<u4")
                    edges = np.append(0, ends).tolist()
                    k = 0
                    for values, text in zip(scores, texts[done : done + len(scores)], strict=True):
                        lists, wanted = range(k, k + len(values)), text.encode()
                        columns["scores"].append(values)
                        columns["lengths"].append([edges[j + 1] - edges[j] for j in lists])
                        columns["crc32s"].append([zlib.crc32(small[edges[j] : edges[j + 1]]) for j in lists])
                        columns["round_trips"].append([read[j] == wanted for j in lists])
                        k += len(values)
                    done += len(scores)
                kinds = (pa.float64(), pa.int64(), pa.int64(), pa.bool_())
                arrays = [pa.array(v, pa.list_(kind)) for v, kind in zip(columns.values(), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], ["doc_id", *columns])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(task, _DIGESTED).select(
        "doc_id",
        F.get("lengths", F.lit(0)).alias("n_pieces"),
        F.get("crc32s", F.lit(0)).alias("ids_crc32"),
        F.get("scores", F.lit(0)).alias("best_score"),
        F.get("scores", F.lit(1)).alias("second_score"),
        F.size("scores").alias("n_scores"),
        F.element_at("scores", -1).alias("last_score"),
        F.get("round_trips", F.lit(0)).alias("round_trip"),
        F.size("lengths").alias("n_lists"),
        "lengths",
        "crc32s",
        "round_trips",
    )
