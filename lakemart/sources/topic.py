"""An event topic as an appended log, read as a stream whose offset is a byte position per file.

A topic is one file of lines, or a folder of such files, that producers append to. A run reads from the byte where the
one before ended up to the last finished line, in pieces that Spark reads side by side; a line without its line end is
still being written and stays for a later run. A file shorter than what was read of it is an error. A topic that is not
there is an empty one.

Files are opened with Arrow's file systems (local or mounted paths, ``file:``, ``s3a:``, ``gs:``, ``hdfs:``), because
Spark's own readers only know whole files.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

PIECE, BUFFER, CELL_LINES = 32 << 20, 1 << 20, 10_000
LINES = "value binary, file string, piece long, place long"
CELLS = "file string, start long, stop long, lines long"
_NEWLINE = 10
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True

# The source runs in Python processes that may lack the package, so its classes travel with it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Positions = Mapping[str, int]


# ---------------------------------------------------------------- files


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def _files(path: str) -> dict[str, fs.FileInfo]:
    """Files of the topic by name; names with a leading dot or underscore belong to writers."""
    system, place = _open(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        return {}
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(place))
    return {f.base_name: f for f in sorted(found, key=lambda f: f.base_name) if f.is_file and f.base_name[0] not in "._"}


def finished(path: str, known: Positions) -> dict[str, int]:
    """Where the last finished line of every file ends; files of ``known`` that are gone keep their position."""
    system, _ = _open(path)
    ends = dict(known)
    for name, info in _files(path).items():
        start = known.get(name, 0)
        if info.size < start:
            raise ValueError(f"topic file {name} has {info.size} bytes, but {start} of it have been read")
        if info.size == start:
            continue
        with system.open_input_file(info.path) as file:
            stop = info.size
            while stop > start:
                at = max(start, stop - BUFFER)
                file.seek(at)
                last = file.read(stop - at).rfind(b"\n")
                if last >= 0:
                    ends[name] = at + last + 1
                    break
                stop = at
    return dict(sorted(ends.items()))


@dataclass
class Piece(InputPartition):
    """Bytes [start, stop) of a file. Lines belong to the piece in which they start; ``first`` starts with a line."""

    path: str
    file: str
    start: int
    stop: int
    first: bool


def pieces(path: str, start: Positions, end: Positions, size: int) -> list[Piece]:
    places = {name: info.path for name, info in _files(path).items()}
    out = []
    for name, stop in sorted(end.items()):
        begin = start.get(name, 0)
        if begin < stop and name not in places:
            raise FileNotFoundError(f"topic file {name} is gone before bytes {begin} to {stop} were read")
        for at in range(begin, stop, size):
            out.append(Piece(places[name], name, at, min(at + size, stop), at == begin))
    return out


def _blocks(topic: str, piece: Piece, end: int) -> Iterator[tuple[int, bytes]]:
    """Whole lines of a piece as (place of the first line, bytes), some ``BUFFER`` bytes at a time."""
    system, _ = _open(topic)
    with system.open_input_file(piece.path) as file:
        at = piece.start if piece.first else piece.start - 1
        file.seek(at)
        rest, skip = b"", not piece.first
        while at < piece.stop or rest:
            data = file.read(min(BUFFER, end - at - len(rest))) if at + len(rest) < end else b""
            if not data and not rest:
                return
            rest += data
            if skip:
                cut = rest.find(b"\n")
                if cut < 0:
                    at, rest = at + len(rest), b""
                    if at >= piece.stop:
                        return
                    continue
                at, rest, skip = at + cut + 1, rest[cut + 1 :], False
            if at >= piece.stop:
                return
            last = rest.rfind(b"\n")
            if last < 0:
                if not data:
                    return
                continue
            whole, rest = rest[: last + 1], rest[last + 1 :]
            if at + len(whole) > piece.stop:  # lines that start behind the piece are the next one's
                cut = whole.find(b"\n", piece.stop - at - 1)
                yield at, whole[: cut + 1]
                return
            yield at, whole
            at += len(whole)


def _line_starts(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start of each line of a block with its end appended, and which lines hold more than blanks."""
    data = np.frombuffer(block, np.uint8)
    edges = np.concatenate([[0], np.flatnonzero(data == _NEWLINE) + 1])
    filled = np.add.reduceat(~_BLANK[data], edges[:-1]) > 0
    return edges, filled


def read_lines(topic: str, piece: Piece, end: int) -> Iterator[pa.RecordBatch]:
    """The lines of a piece that are not blank, with their file, the start of the piece and their own first byte."""
    for at, block in _blocks(topic, piece, end):
        edges, filled = _line_starts(block)
        values = pa.Array.from_buffers(
            pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(block)]
        )
        n = int(filled.sum())
        columns = [
            values.filter(pa.array(filled)),
            pa.array([piece.file] * n, pa.string()),
            pa.array(np.full(n, piece.start, np.int64)),
            pa.array(edges[:-1][filled] + at, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["value", "file", "piece", "place"])


def read_cells(topic: str, piece: Piece, end: int, most: int) -> Iterator[pa.RecordBatch]:
    """The piece cut into cells of at most ``most`` lines that are not blank, with their number."""
    rows, start, lines, stop = [], None, 0, 0
    for at, block in _blocks(topic, piece, end):
        edges, filled = _line_starts(block)
        start = at if start is None else start
        counted = lines + np.cumsum(filled)
        while counted[-1] >= most:
            cut = int(np.searchsorted(counted, most))
            rows.append((piece.file, start, at + int(edges[cut + 1]), most))
            start, lines = at + int(edges[cut + 1]), 0
            counted = counted - most
        lines, stop = int(counted[-1]), at + len(block)
    if start is not None and start < stop:
        rows.append((piece.file, start, stop, lines))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=["file", "start", "stop", "lines"])


def place_after(topic: str, name: str, start: int, stop: int, lines: int) -> int:
    """The byte behind the next ``lines`` lines that are not blank, inside [start, stop)."""
    piece = Piece(_files(topic)[name].path, name, start, stop, True)
    for at, block in _blocks(topic, piece, stop):
        edges, filled = _line_starts(block)
        counted = np.cumsum(filled)
        if counted[-1] >= lines:
            return at + int(edges[int(np.searchsorted(counted, lines)) + 1])
        lines -= int(counted[-1])
    return stop


def count_lines(topic: str, name: str, start: int, stop: int) -> int:
    """Lines in [start, stop) that are not blank."""
    piece = Piece(_files(topic)[name].path, name, start, stop, True)
    return sum(int(_line_starts(block)[1].sum()) for _, block in _blocks(topic, piece, stop))


# ---------------------------------------------------------------- source


class TopicLog(DataSource):
    """Format ``topic_log``: a stream of lines, or as a batch the cells of what lies between two positions.

    Options: ``path``; ``known``, positions as JSON that the source starts to look from; ``until``, positions as JSON
    where this run of the stream ends; ``piece``, bytes per partition; ``cell``, lines per cell of a batch.
    """

    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return CELLS if self.options.get("cell") else LINES

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TopicStream(self.options)

    def reader(self, schema: StructType) -> DataSourceReader:
        return TopicCells(self.options)


class TopicStream(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.piece = options["path"], int(options.get("piece", PIECE))
        self.known = json.loads(options.get("known", "{}"))
        self.until = json.loads(options["until"]) if options.get("until") else None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.until if self.until is not None else finished(self.path, self.known)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.ends = end
        return [_Bounded(p, end[p.file]) for p in pieces(self.path, start, end, self.piece)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_lines(self.path, partition.piece, partition.end)


class TopicCells(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.piece = options["path"], int(options.get("piece", PIECE))
        self.known, self.until = json.loads(options["known"]), json.loads(options["until"])
        self.cell = int(options["cell"])

    def partitions(self) -> Sequence[InputPartition]:
        return [_Bounded(p, self.until[p.file]) for p in pieces(self.path, self.known, self.until, self.piece)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return read_cells(self.path, partition.piece, partition.end, self.cell)


@dataclass
class _Bounded(InputPartition):
    piece: Piece
    end: int  # where the range ends of which the piece is a part


def line_stream(spark: SparkSession, path: str, known: Positions, until: Positions | None, piece: int = PIECE) -> DataFrame:
    spark.dataSource.register(TopicLog)
    reader = spark.readStream.format("topic_log").option("piece", piece).option("known", json.dumps(dict(known)))
    if until is not None:
        reader = reader.option("until", json.dumps(dict(sorted(until.items()))))
    return reader.load(path)


def line_cells(
    spark: SparkSession, path: str, known: Positions, until: Positions, piece: int = PIECE, cell: int = CELL_LINES
) -> DataFrame:
    """file, start, stop, lines of consecutive stretches between two positions: the places of every ``cell``-th line."""
    spark.dataSource.register(TopicLog)
    reader = spark.read.format("topic_log").option("piece", piece).option("cell", cell)
    return reader.option("known", json.dumps(dict(known))).option("until", json.dumps(dict(until))).load(path)


def append_lines(lines: DataFrame, path: str) -> None:
    """Append the text column of ``lines`` to a topic folder; every partition writes a file of its own.

    Like any producer without transactions it writes at least once: a task that is run again appends again, and the
    repeated events are left to the exact dedup in silver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _open(path)
        system.create_dir(place, recursive=True)
        with system.open_append_stream(f"{place}/{TaskContext.get().partitionId():05d}.jsonl") as file:
            for batch in batches:
                file.write(b"".join(line.encode() + b"\n" for line in batch.column(0).to_pylist()))
        yield from ()

    lines.mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
