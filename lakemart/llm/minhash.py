"""Near-duplicate documents with circulant MinHash.

One permutation scatters the shingles over a universe of ``2**UNIVERSE_BITS`` places, a second one gives every place
its rank; signature coordinate k is the smallest rank after the second permutation is shifted circularly by k. So one
table serves all coordinates, and the coordinates of a shingle are a contiguous slice of it. Signatures are cut into
bands; documents that share a band are candidates; links are confirmed on the full shingle sets.

Candidates are never expanded into all pairs of a band. Documents with equal sets are one node, and all bands with the
same smallest node, their hub, are one family. Every family first compares its members with the hub only, which joins
most of them under one label; then only families with several labels are left, and there the members outside the most
frequent label are compared with all others, in bounded blocks, through an index of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import components
from lakemart.llm.hashing import mix, piece_hashes, utf8
from lakemart.llm.held import held, release
from lakemart.sources.lake import Workspace

SHINGLE = 5
ROWS = 5
MISS = 5e-7  # chance that a pair at the threshold shares no band
UNIVERSE_BITS = 22
THRESHOLD = 85
BLOCK, SALT = 1024, 32
_U = np.uint64


def bands_for(threshold: int) -> int:
    """Bands of ``ROWS`` coordinates that a pair at the threshold misses altogether with a chance of ``MISS`` at most."""
    if not 0 < threshold <= 100:
        raise ValueError(f"threshold {threshold} is no percentage above 0")
    share = (threshold / 100) ** ROWS
    return 1 if share == 1 else math.ceil(math.log(MISS) / math.log(1 - share))


def _shifted(coordinates: int) -> np.ndarray:
    """Row i holds the ranks of place i under so many shifts: a window view on one permutation."""
    return held(("ranks", coordinates), lambda: _drawn_ranks(coordinates))


def _drawn_ranks(coordinates: int) -> np.ndarray:
    ranks = np.arange(1 << UNIVERSE_BITS, dtype=np.uint32)
    np.random.Generator(np.random.PCG64(0xC1C)).shuffle(ranks)
    ring = np.concatenate([ranks, ranks[: coordinates - 1]])
    return np.lib.stride_tricks.sliding_window_view(ring, coordinates)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` make one shingle, no words make none."""
    words, counts = piece_hashes(texts)
    ends = np.cumsum(counts)
    total = len(words) - size + 1
    if total > 0:
        rolled = np.zeros(total, np.uint64)
        for k in range(size):
            rolled += mix(words[k : k + total] + _U(k * 0x9E37 + 1))
        rolled = mix(rolled)
    out = []
    for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
        if count >= size:
            found = np.sort(rolled[end - count : end - size + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif count:
            short = mix(words[end - count : end] + _U(1) + np.arange(count, dtype=np.uint64) * _U(0x9E37))
            out.append(mix(short.sum(dtype=np.uint64, keepdims=True) + np.array([count], np.uint64) * _U(0xC2B2AE3D27D4EB4F)))
        else:
            out.append(words[:0])
    return out


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates of one set; the work array is bounded whatever the set holds."""
    places = (mix(shingles ^ _U(0xA5A5A5A5)) >> _U(64 - UNIVERSE_BITS)).astype(np.int64)
    table, least = _shifted(coordinates), None
    for at in range(0, len(places), 2048):
        part = table[places[at : at + 2048]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature; equal rows of the same band give equal keys."""
    rows = signatures.reshape(len(signatures), -1, ROWS).astype(np.uint64)
    salted = rows + (np.arange(signatures.shape[1], dtype=np.uint64) << _U(32)).reshape(-1, ROWS)
    return mix(mix(salted).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    first = shingles.sum(dtype=np.uint64)
    second = mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(first.view(np.int64)), int(second.view(np.int64))


_SKETCH = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"
_SETS = "n_shingles long, s1 long, s2 long, shingles binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])


def sketches(docs: DataFrame, threshold: int = THRESHOLD, carry: str | None = None) -> DataFrame:
    """Set size, set fingerprint and band keys of every document, and as ``row`` the long column ``carry``."""
    coordinates = bands_for(threshold) * ROWS
    ddl = f"{_SKETCH}, row long" if carry else _SKETCH
    schema = _arrow(ddl)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = shingle_sets(utf8(part.column("text").to_pylist()))
                marks = [_fingerprint(s) for s in sets]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list[list[int]] = [[]] * len(sets)
                if full:
                    for i, keys in zip(full, band_keys(np.stack([signature(sets[i], coordinates) for i in full])).tolist(), strict=True):
                        bands[i] = keys
                columns = [part.column("doc_id").to_pylist(), [len(s) for s in sets], [m[0] for m in marks], [m[1] for m in marks]]
                columns += [bands, *([part.column("row").to_pylist()] if carry else [])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    row = [F.col(carry).alias("row")] if carry else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *row).mapInArrow(task, ddl)


def _sets(docs: DataFrame) -> DataFrame:
    schema = _arrow(_SETS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = shingle_sets(utf8(batch.slice(at, 512).column("text").to_pylist()))
                marks = [_fingerprint(s) for s in sets]
                columns = [[len(s) for s in sets], [m[0] for m in marks], [m[1] for m in marks], [s.tobytes() for s in sets]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    return docs.select("text").mapInArrow(task, _SETS)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= threshold * union, on the full sets."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.toDF(side, f"set_{side}"), side)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (one, other))
                merged = np.sort(np.concatenate([left, right]))
                both = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * both >= threshold * (len(merged) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(task, "a long, b long")


class _Index:
    """Which of a few sets hold a shingle."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(x) for x in sets], np.int64)
        flat = np.concatenate([np.empty(0, np.uint64), *sets])
        order = np.argsort(flat, kind="stable")
        self.keys, self.owners = flat[order], np.repeat(np.arange(len(sets)), sizes)[order]
        self.sizes = sizes

    def links(self, shingles: np.ndarray, threshold: int) -> np.ndarray:
        """Numbers of the sets that are linked with this one."""
        low, high = np.searchsorted(self.keys, shingles, "left"), np.searchsorted(self.keys, shingles, "right")
        counts = high - low
        total = np.cumsum(counts)
        places = np.repeat(low - (total - counts), counts) + np.arange(int(total[-1]) if len(total) else 0)
        both = np.bincount(self.owners[places], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= threshold * (self.sizes + len(shingles) - both))


def _across(members: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between nodes of one family but not one label, enough to join all labels that links join.

    ``members`` has hub, node, label, shingles of families with several labels. In each, the nodes outside the most
    frequent label, in blocks, meet all nodes, in blocks, so the work grows with the nodes that are still apart and
    every group is bounded. A block pair returns one link at most for each node and label. Block pairs are dealt out one
    by one, and the members of a family meet its plan in ``SALT`` parts, so no task has a whole family.
    """
    of_label = members.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))
    plan = of_label.groupBy("hub").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    plan = plan.select(
        "hub",
        "main",
        F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("asking_blocks"),
    )
    spot = F.xxhash64("node")
    salted = members.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(SALT)).cast("int"))
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    dealt = salted.join(plan.hint("merge"), ["hub", "salt"]).select(
        "hub", "node", "label", "shingles", "blocks", "asking_blocks",
        (F.col("label") != F.col("main")).alias("asks"),
        F.pmod(spot, F.col("blocks")).cast("int").alias("block"),
        F.pmod(spot, F.col("asking_blocks")).cast("int").alias("asking"),
    )
    columns = ["hub", "node", "label", "shingles"]
    answer = dealt.select(*columns, "block", F.explode(F.sequence(F.lit(0), F.col("asking_blocks") - 1)).alias("asking"), F.lit(False).alias("asks"))
    ask = dealt.where("asks").select(*columns, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "asking", "asks")

    def group(table: pa.Table) -> pa.Table:
        nodes, labels = table.column("node").to_numpy(), table.column("label").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        here = np.flatnonzero(~asks)
        index = _Index([sets[i] for i in here])
        a, b = [], []
        for i in np.flatnonzero(asks):
            found = here[index.links(sets[i], threshold)]
            found = found[labels[found] != labels[i]]
            _, first = np.unique(labels[found], return_index=True)
            a += [int(nodes[i])] * len(first)
            b += nodes[found[first]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # Without the exchange Spark would go on with the partitions by hub that the joins have left.
    both = answer.unionByName(ask).repartition("hub", "block", "asking")
    return both.groupBy("hub", "block", "asking").applyInArrow(group, "a long, b long")


_MARK = ["n_shingles", "s1", "s2"]


def near_groups(docs: DataFrame, work: Workspace, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Two documents are linked if 100 * intersection >= ``threshold`` * union of their five-word shingle sets; the
    component_id is the smallest doc_id that links reach, and the row with that doc_id is kept. Null, empty and
    blank texts have no shingles and are linked with nothing: their component is their own doc_id. A null doc_id
    counts only where no other is in the component, and is then kept. Rows with equal doc_id are told apart by
    their texts. An empty table gives no rows; other columns are ignored. The number of bands follows from the threshold,
    so that a pair there shares no band with a chance of 5e-7 at most; all other steps are exact.
    """
    drawn = sketches(docs, threshold).withColumn("row", F.monotonically_increasing_id())
    drawn = work.save(drawn, "sketches")
    out = drawn.select("doc_id", *_MARK).join(_classes(docs, drawn, work, threshold), _MARK, "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _classes(docs: DataFrame, drawn: DataFrame, work: Workspace, threshold: int) -> DataFrame:
    """Every set that is not empty (size and fingerprints) with its label, unlike in all components, and component_id."""
    nodes = drawn.where("n_shingles > 0").groupBy(*_MARK).agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    nodes = work.save(nodes.join(drawn.select(F.col("row").alias("node"), "bands"), "node"), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = work.save(banded.join(hubs.select("key", "hub"), "key").select("hub", "node").distinct(), "shared")
    sets = _sets_of(docs, nodes, shared.select("node").distinct(), work)
    stars = shared.where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = work.save(_confirmed(stars, sets, threshold), "links")
    # A label is a linked hub, or that hub's own label: nodes under one label are connected, others may be.
    near = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    far = near.select(F.col("node").alias("label"), F.col("label").alias("far"))
    labels = near.join(far, "label", "left").select("node", F.coalesce("far", "label").alias("label"))
    marked = shared.join(labels, "node", "left")
    marked = work.save(marked.withColumn("label", F.coalesce("label", "node")), "marked")
    several = marked.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    members = marked.join(several.select("hub"), "hub", "left_semi").join(sets, "node")
    more = work.save(_across(members, threshold).distinct(), "more_links")
    joined = components(links.unionByName(more), work)
    named = nodes.select(*_MARK, "node", "first_id").join(joined, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    firsts = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = work.save(named.join(firsts, "label").select(*_MARK, "label", "component_id"), "classes")
    work.drop("nodes", "shared", "wanted", "sets", "sets_once", "links", "marked", "more_links")
    return classes


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, work: Workspace) -> DataFrame:
    """Full sets (node, shingles) of the wanted nodes, drawn again from the texts of those nodes only."""
    wanted = nodes.join(wanted, "node", "left_semi").select("node", "first_id", "n_shingles", "s1", "s2")
    wanted = work.save(wanted, "wanted")
    # The ids grow with the corpus, so they are never broadcast: the plan is the same at every size.
    ids = wanted.select(F.col("first_id").alias("id")).distinct().hint("merge")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(ids["id"]), "left_semi")
    drawn = _sets(texts).join(wanted.drop("first_id"), ["n_shingles", "s1", "s2"])
    found = work.save(drawn.select("node", "shingles"), "sets")
    if found.count() > wanted.count():  # rows that repeat doc_id and text
        found = work.save(found.dropDuplicates(["node"]), "sets_once")
    return found


def distinct_docs(docs: DataFrame, work: Workspace, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each component of ``near_groups``, with all its columns; rows without shingles all stay.

    Rows are told apart by doc_id and set, so a doc_id that occurs with several texts, or none at all, is no hindrance:
    of a component the smallest doc_id stays (nulls last), of its texts the one with the smallest set fingerprint, and
    of rows equal in both any one.
    """
    mark = "_row"
    while mark in docs.columns:
        mark += "_"
    rows = work.save(docs.withColumn(mark, F.monotonically_increasing_id()), "rows")
    drawn = work.save(sketches(rows, threshold, mark), "sketches")
    classes = _classes(docs, drawn, work, threshold)
    sets = drawn.where("n_shingles > 0").select("row", F.col("doc_id").isNull().alias("late"), "doc_id", *_MARK).join(classes, _MARK)
    first = F.min(F.struct("late", "doc_id", *_MARK, "row"))
    kept = sets.groupBy("label").agg(first.alias("first")).select(F.col("first.row").alias(mark))
    kept = work.save(kept.unionByName(drawn.where("n_shingles = 0").select(F.col("row").alias(mark))), "kept")
    return rows.join(kept.hint("merge"), mark, "left_semi").drop(mark)
