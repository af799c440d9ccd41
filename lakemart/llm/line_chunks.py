"""Line deduplication with content-defined chunks.

Every line has a hash, and a rolling hash over the last lines decides after which lines a chunk ends, so an inserted
line shifts one boundary and not all that follow. Chunks of several lines are grouped by the hashes of their lines; those
that the corpus holds more than once are compared with their first copy, by SHA-256 of their bytes, and all but that
copy are removed.

A passage that lies across chunk ends holds no whole chunk, or loses its edges. So there are passages too: every two
neighbouring lines, and every single long line, are looked up by themselves, and a repeated run of any length goes
from its first line to its last. Every repeated chunk is such a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.hashing import SAME, lut, mix, piece_hashes, utf8
from lakemart.sources.lake import Workspace

WINDOW, DIVISOR = 2, 3
LEAST_LINES, MOST_LINES = 2, 64
LONG_WORDS = 50
_U = np.uint64
_LINE_END = lut(b"\n")


def line_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Hash of every line of each text; empty lines have one too, as a text is split at every line end."""
    marked = [b"\x00" + t.replace(b"\n", b"\n\x00") for t in texts]  # a mark, so that no line is empty
    hashes, counts = piece_hashes(marked, _LINE_END, SAME)
    ends = np.cumsum(counts)
    return [hashes[b - n : b] for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]


def boundaries(lines: np.ndarray, window: int = WINDOW, divisor: int = DIVISOR, most: int = MOST_LINES) -> np.ndarray:
    """End positions of the chunks, the last being the number of lines.

    A chunk ends behind a line if the rolling hash of the last ``window`` lines leaves 0 by ``divisor``. Longer runs
    without such a line are cut where the hash is smallest among ``most`` lines, which depends on content alone too.
    """
    n = len(lines)
    if not n:
        return np.zeros(0, np.int64)
    rolling = np.zeros(n, np.uint64)
    for k in range(window):
        rolling[k:] += mix(lines[: n - k] + _U(k + 1))
    rolling = mix(rolling)
    ends = np.flatnonzero(rolling % _U(divisor) == 0) + 1
    ends = np.unique(np.append(ends[ends < n], n))
    if int(np.diff(ends, prepend=0).max()) <= most:
        return ends
    out, start = [], 0
    for end in ends.tolist():
        while end - start > most:
            start += int(rolling[start : start + most].argmin()) + 1
            out.append(start)
        out.append(end)
        start = end
    return np.array(out, np.int64)


def _chunk_digests(lines: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes per chunk, of its line hashes in order."""
    starts = np.append(0, ends[:-1])
    place = (np.arange(len(lines)) - np.repeat(starts, ends - starts)).astype(np.uint64)
    first = np.add.reduceat(mix(lines + place * _U(0x9E3779B97F4A7C15)), starts)
    second = np.add.reduceat(mix((lines ^ _U(0x5851F42D4C957F2D)) + place * _U(0xC2B2AE3D27D4EB4F)), starts)
    return mix(first + (ends - starts).astype(np.uint64)), mix(second)


_KEYS = ["id", "mark"]
_CHUNKS = "id long, mark long, late boolean, chunk int, from_line int, n_lines int, d1 long, d2 long, proof binary"
_KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with columns that tell them apart: the id and a hash of id and text. Rows equal in both are one document."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    return docs.select(
        doc_id.isNull().alias("late"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(doc_id, text).alias("mark"), text.alias("text")
    )


def chunks(rows: DataFrame) -> DataFrame:
    """The chunks of at least LEAST_LINES lines of every row; ``proof`` is the SHA-256 of a chunk's bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys = [part.column(c).to_pylist() for c in ("id", "mark", "late")]
                columns: list[list] = [[] for _ in _KINDS]
                texts = utf8(part.column("text").to_pylist())
                for row, lines in enumerate(line_hashes(texts)):
                    ends = boundaries(lines)
                    starts = np.append(0, ends[:-1])
                    long = np.flatnonzero(ends - starts >= LEAST_LINES)
                    if len(long):
                        d1, d2 = _chunk_digests(lines, ends)
                        own = [long, starts[long], (ends - starts)[long], d1[long].view(np.int64), d2[long].view(np.int64)]
                        for k in range(3):
                            columns[k] += [keys[k][row]] * len(long)
                        for k, values in enumerate(own, 3):
                            columns[k] += values.tolist()
                        spelled = texts[row].split(b"\n")
                        columns[8] += [sha256(b"\n".join(spelled[starts[k] : ends[k]])).digest() for k in long]
                names = [f.split(" ")[0] for f in _CHUNKS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names)

    return rows.select("id", "mark", "late", "text").mapInArrow(task, _CHUNKS)


def repeated_chunks(rows: DataFrame, work: Workspace) -> DataFrame:
    """(id, mark, from_line, n_lines) of every chunk that is byte for byte an earlier one, by id and place.

    Chunks are counted by their line hashes first, with map-side combining, so a chunk that a third of all rows hold is
    one entry per task; the bytes of every repeated one are then compared with those of the first.
    """
    found = work.save(chunks(rows), "chunks")
    place = F.struct("late", "id", "mark", "chunk", "proof")
    groups = found.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    groups = work.save(groups.select("d1", "d2", "first"), "groups")
    same = found.join(groups, ["d1", "d2"]).where((F.col("proof") == F.col("first.proof")) & (place != F.col("first")))
    return same.select(*_KEYS, "from_line", "n_lines").distinct()


_PIECES = "id long, mark long, late boolean, line int, n_lines int, d1 long, d2 long"
_PIECE_KINDS = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]


def _pieces_of(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(line, number of lines, bytes) of every two neighbouring lines and of every line of more than LONG_WORDS words."""
    start, before, number = 0, None, 0
    while start <= len(text):
        end = text.find(b"\n", start)
        end = len(text) if end < 0 else end
        if before is not None:
            yield number - 1, 2, text[before:end]
        if end - start > 2 * LONG_WORDS and len(text[start:end].split()) > LONG_WORDS:
            yield number, 1, text[start:end]
        start, before, number = end + 1, start, number + 1


def pieces(rows: DataFrame) -> DataFrame:
    """Pairs of neighbouring lines and single long lines of every row; d1 and d2 are half of the SHA-256 of their bytes."""
    names = [f.split(" ")[0] for f in _PIECES.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                owner, lines, sizes, digests = [], [], [], []
                for row, text in enumerate(utf8(part.column("text").to_pylist())):
                    for line, size, data in _pieces_of(text):
                        owner.append(row)
                        lines.append(line)
                        sizes.append(size)
                        digests.append(sha256(data).digest()[:16])
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                keys = [part.column(c).take(pa.array(owner, pa.int64())) for c in ("id", "mark", "late")]
                own = [pa.array(c, k) for c, k in zip((lines, sizes, halves[:, 0], halves[:, 1]), _PIECE_KINDS[3:], strict=True)]
                yield pa.RecordBatch.from_arrays([*keys, *own], names)

    return rows.select("id", "mark", "late", "text").mapInArrow(task, _PIECES)


def repeated_passages(rows: DataFrame, work: Workspace) -> DataFrame:
    """(id, mark, from_line, n_lines) of every piece that is byte for byte an earlier one, by id and place.

    The first place of a line is never in a repeated piece, so no line is lost everywhere. Two lines that overlap their
    own first copy, as in a run of equal lines, are no second copy.
    """
    found = work.save(pieces(rows), "pieces")
    place = F.struct("late", "id", "mark", "line")
    groups = found.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    groups = work.save(groups.select("d1", "d2", "first"), "groups")
    over = F.struct("late", "id", "mark", (F.col("line") - 1).alias("line")) == F.col("first")
    same = found.join(groups, ["d1", "d2"]).where((place != F.col("first")) & ~((F.col("n_lines") == 2) & over))
    return same.select(*_KEYS, F.col("line").alias("from_line"), "n_lines")


def without_repeats(docs: DataFrame, work: Workspace, passages: bool = False) -> DataFrame:
    """doc_id, text, n_lines, removed_lines, removed_chunks for every row of ``docs`` (doc_id, text).

    Repeated chunks of at least two lines are taken out everywhere but at their first place in the corpus (smallest
    doc_id, nulls last); the lines left are joined again. Rows that repeat doc_id and text are one document and keep
    alike. Null texts count as empty; a text without line end is one line and never a chunk; a document of repeated
    chunks only has an empty text. An empty table gives no rows; other columns are ignored.

    With ``passages``, every repeated run of two or more lines goes whole, wherever the chunks end, and so does every
    repeated line of more than LONG_WORDS words, also one that is the whole text; removed_chunks then counts the runs
    of lines that are gone.
    """
    rows = _keyed(docs)
    repeats = repeated_passages(rows, work) if passages else repeated_chunks(rows, work)
    gone = repeats.groupBy(*_KEYS).agg(F.collect_set(F.struct("from_line", "n_lines")).alias("gone"))
    # The places grow with the corpus, so they are never broadcast: texts meet them in one shuffle at every size.
    joined = rows.join(work.save(gone, "gone").hint("merge"), _KEYS, "left")
    joined = joined.select(F.when(~F.col("late"), F.col("id")).alias("doc_id"), "text", "gone")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, sizes, lost, times = [], [], [], []
                for text, gone in zip(part.column("text").to_pylist(), part.column("gone").to_pylist(), strict=True):
                    lines = text.split("\n")
                    drop = np.zeros(len(lines), bool)
                    for piece in gone or ():
                        drop[piece["from_line"] : piece["from_line"] + piece["n_lines"]] = True
                    texts.append("\n".join(line for line, d in zip(lines, drop, strict=True) if not d) if gone else text)
                    sizes.append(len(lines))
                    lost.append(int(drop.sum()))
                    times.append(int(np.diff(drop, prepend=False)[drop].sum()) if passages else len(gone or ()))
                longs = [pa.array(x, pa.int64()) for x in (sizes, lost, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.string()), *longs],
                    ["doc_id", "text", "n_lines", "removed_lines", "removed_chunks"],
                )

    return joined.mapInArrow(task, "doc_id long, text string, n_lines long, removed_lines long, removed_chunks long")
