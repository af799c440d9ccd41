"""Exact ranked lexical search with sparse ball trees.

A document is a sparse vector of whole-number impacts, an item a sparse vector of term weights, and a score is their
inner product. Each task puts its documents, slice by slice, into a ball tree: every node knows its centroid, the radius
around it, and the radius along each single coordinate. Both radii bound the score of all documents below a node; the
bounds are rounded up, so they are never too small. Nodes are visited best-first, item by item, until no bound reaches
the item's tenth best score, which carries over from slice to slice. Leaves are scored in 64-bit integers.

Terms that no item of a block holds add nothing to any score, so they are left out of the vectors of that block. Items
come in blocks of bounded size, the only thing that is sent to every task.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.divergence import slices
from lakemart.llm.tables import running_total, text_or_empty
from lakemart.sources.lake import Workspace

NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP, LEAF, AXES = 10, 16, 24
BLOCK_TERMS, ITEM_LEAST = 1 << 14, 64
SLICE_ENTRIES, SLICE_CELLS = 1 << 20, 1 << 22
_VECTORS = "doc_id long, n long, terms array<int>, tfs array<long>"
_SLACK = 1 + 1e-9

Best = list[tuple[int, int, int]]  # (-score, 1 or 0 for a null doc_id, doc_id), best first


# ---------------------------------------------------------------- vectors


def _vectors(vocabulary: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of terms, and the block's terms with their occurrences, for each text."""
    wanted = pa.array(vocabulary, pa.string())
    for batch in batches:
        for piece in slices(batch, "text"):
            words = pc.split_pattern_regex(pc.ascii_lower(piece.column("text")), pattern=NOT_TERM)
            row, word = pc.list_parent_indices(words).to_numpy(), pc.list_flatten(words)
            real = pc.not_equal(word, "").to_numpy(zero_copy_only=False)
            code = pc.index_in(word, value_set=wanted).fill_null(-1).to_numpy()
            n = np.bincount(row[real], minlength=len(piece))
            here = code >= 0
            found, tf = np.unique(row[here].astype(np.int64) * len(vocabulary) + code[here], return_counts=True)
            ends = np.searchsorted(found, (np.arange(len(piece) + 1)) * len(vocabulary)).astype(np.int32)
            ends = pa.array(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").cast(pa.int64()),
                    pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array((found % len(vocabulary)).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64))),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )


def vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(lambda batches: _vectors(vocabulary, batches), _VECTORS)


# ---------------------------------------------------------------- ball tree


class Tree:
    """A ball tree over the rows of a sparse matrix (``ends``, ``terms``, ``impacts``); nodes are numbered from the root.

    ``scale`` stretches the coordinates before distances are taken; it does not change inner products with vectors
    that are shrunk alike.
    """

    def __init__(self, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        rows, width = len(ends) - 1, len(scale)
        own = np.repeat(np.arange(rows), np.diff(ends))
        values = impacts * scale[terms]
        axes = np.random.Generator(np.random.PCG64(7)).normal(size=(AXES, width))
        places = np.stack([np.bincount(own, values * axis[terms], rows) for axis in axes], axis=1)
        self.children: list[tuple[int, int] | None] = []
        self.spans: list[tuple[int, int]] = []
        order = np.arange(rows)
        todo = [(0, rows, -1)]
        while todo:  # the halves of a node are next to each other in ``order``
            start, stop, parent = todo.pop()
            node = len(self.spans)
            self.spans.append((start, stop))
            self.children.append(None)
            if parent >= 0:
                known = self.children[parent]
                self.children[parent] = (node, -1) if known is None else (known[0], node)
            if stop - start > leaf:
                order[start:stop] = self._halved(order[start:stop], places)
                middle = (start + stop) // 2
                todo += [(middle, stop, node), (start, middle, node)]
        self.order = order
        self._lay_out(ends, terms, impacts, values)
        self._bound(width)

    @staticmethod
    def _halved(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rows along the line between two far ones; ties keep their order, so equal rows are split evenly."""
        points = places[rows]
        one = points[((points - points.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        other = points[((points - one) ** 2).sum(axis=1).argmax()]
        return rows[np.argsort(points @ (other - one), kind="stable")]

    def _lay_out(self, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray, values: np.ndarray) -> None:
        """Entries in the order of the leaves."""
        lengths = np.diff(ends)[self.order]
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(ends[:-1][self.order] - self.ends[:-1], lengths) + np.arange(self.ends[-1])
        self.terms, self.impacts, self.values = terms[take], impacts[take], values[take]

    def _bound(self, width: int) -> None:
        """Centroid, greatest coordinate and radius of every node, children before parents."""
        nodes = len(self.spans)
        self.centroid, self.greatest = np.zeros((nodes, width)), np.zeros((nodes, width))
        self.radius = np.zeros(nodes)
        lengths = np.diff(self.ends)
        own = np.repeat(np.arange(len(lengths)), lengths)
        squares = np.bincount(own, self.values**2, len(lengths))
        for node in range(nodes - 1, -1, -1):
            start, stop = self.spans[node]
            entries = slice(self.ends[start], self.ends[stop])
            terms, values = self.terms[entries], self.values[entries]
            if self.children[node] is None:
                np.maximum.at(self.greatest[node], terms, values)
            else:
                one, other = self.children[node]
                np.maximum(self.greatest[one], self.greatest[other], out=self.greatest[node])
            centre = np.bincount(terms, values, width) / (stop - start)
            self.centroid[node] = centre
            norm = float(centre @ centre)
            dots = np.bincount(own[entries] - start, values * centre[terms], stop - start)
            far = squares[start:stop] - 2 * dots + norm + 1e-9 * (squares[start:stop] + norm)
            self.radius[node] = math.sqrt(max(0.0, float(far.max())) * _SLACK)

    def bounds(self, items: np.ndarray) -> np.ndarray:
        """For each node and item (rows of ``items``), a score that no row below the node exceeds."""
        ball = self.centroid @ items.T + np.outer(self.radius, np.sqrt((items**2).sum(axis=1)) * _SLACK)
        return np.minimum(ball, self.greatest @ items.T) * _SLACK + 1

    def search(self, bounds: list[float], weights: np.ndarray, ids: list[int | None], best: Best, top: int) -> int:
        """Bring the rows of highest score into ``best``; returns how many leaves were scored."""
        scored, heap = 0, [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            least = -best[-1][0] if len(best) == top else 1
            if -bound < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            scored += 1
            start, stop = self.spans[node]
            first, entries = self.ends[start], slice(self.ends[start], self.ends[stop])
            scores = np.add.reduceat(weights[self.terms[entries]] * self.impacts[entries], self.ends[start:stop] - first)
            for k in np.flatnonzero(scores >= least).tolist():
                doc = ids[self.order[start + k]]
                insort(best, (-int(scores[k]), 0 if doc is None else 1, doc or 0))
                del best[top:]
        return scored


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Rows of several batches, as many as a tree may hold; rows have at least one entry each."""
    most = max(LEAF, SLICE_CELLS // max(1, width) * LEAF // 2)
    held, rows, entries = [], 0, 0
    for batch in batches:
        sizes = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
        start = 0
        while start < len(batch):
            before = int(sizes[start - 1]) if start else 0
            room = int(np.searchsorted(sizes, before + SLICE_ENTRIES - entries, "right")) - start
            take = min(len(batch) - start, most - rows, max(room, 0 if rows else 1))
            if take:
                held.append(batch.slice(start, take))
                rows += take
                start += take
                entries += int(sizes[start - 1]) - before
            if start < len(batch):
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def search_rows(
    batches: Iterator[pa.RecordBatch], items: Sequence[dict[int, int]], weights: Sequence[int], top: int
) -> list[Best]:
    """The best rows for each item (term to repeats) among (doc_id, m, terms, tfs) rows."""
    width = len(weights)
    whole = np.asarray(weights, np.int64)
    repeats = np.zeros((len(items), width), np.int64)
    for k, item in enumerate(items):
        repeats[k, list(item)] = list(item.values())
    scale = np.sqrt(whole)
    stretched, products = repeats * scale, repeats * whole
    best: list[Best] = [[] for _ in items]
    for table in _slices(batches, width):
        lists, tfs = table["terms"].combine_chunks(), table["tfs"].combine_chunks()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
        tf, m = tfs.flatten().to_numpy(), np.repeat(table["m"].to_numpy(), np.diff(ends))
        tree = Tree(ends, lists.flatten().to_numpy().astype(np.int64), 1_000_000_000 * tf // (1000 * tf + 8 * m), scale)
        ids, bounds = table["doc_id"].to_pylist(), tree.bounds(stretched)
        for k in range(len(items)):
            tree.search(bounds[:, k].tolist(), products[k], ids, best[k], top)
    return best


# ---------------------------------------------------------------- items


def item_terms(items: DataFrame, work: Workspace) -> DataFrame:
    """item_id, term, repeats and the block of the item; a block has some ``BLOCK_TERMS`` rows, and one item at least."""
    lowered = F.translate(text_or_empty(), UPPER, LOWER)
    words = items.select("item_id", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
    words = work.save(words.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("repeats")), "item_terms")
    sizes = words.groupBy("item_id").agg(F.greatest(F.count(F.lit(1)), F.lit(ITEM_LEAST)).alias("size"))
    placed = running_total(sizes, ["item_id"], "size", "before", work, "item_sizes")
    placed = placed.select(F.col("item_id").alias("_item"), F.floor(F.col("before") / BLOCK_TERMS).cast("int").alias("block"))
    return words.join(placed, words["item_id"].eqNullSafe(placed["_item"])).drop("_item")


def search(docs: DataFrame, items: DataFrame, work: Workspace, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of highest score for each item, ties by ascending doc_id.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), its impact in a document 10^9 tf div (1000 tf + 8 m) with
    m = 25 + 75 n N div L. Rows of ``docs`` are documents, so repeated rows count and are ranked one by one; a null
    doc_id comes first among equals. Null and empty texts have no terms, score nothing and do not count in N. Rows of
    ``items`` with equal item_id are one item with all their terms; an item without terms, or with terms that no
    document holds, has no rows. Empty tables give no rows. Other columns are not read.
    """
    terms = work.save(item_terms(items, work), "query_terms")
    blocks = terms.agg(F.max("block")).first()[0]
    found: DataFrame | None = None
    for block in range(-1 if blocks is None else blocks + 1):
        rows = terms.where(F.col("block") == block).select("item_id", "term", "repeats").collect()
        part = _search_block(docs, rows, work, f"block_{block}", top)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    best_first = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, rows: list, work: Workspace, name: str, top: int) -> DataFrame:
    vocabulary = sorted({r["term"] for r in rows})
    code = {t: k for k, t in enumerate(vocabulary)}
    names = sorted({r["item_id"] for r in rows}, key=lambda i: (i is not None, i or 0))
    place = {i: k for k, i in enumerate(names)}
    items: list[dict[int, int]] = [{} for _ in names]
    for r in rows:
        items[place[r["item_id"]]][code[r["term"]]] = r["repeats"]
    written = work.save(vectors(docs, vocabulary), name)
    whole = written.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("words")).first()
    n_docs, n_words = whole["docs"], whole["words"] or 0
    held = dict(written.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(k, 0) + 1))) for k in range(len(vocabulary))]
    length = F.expr(f"25 + int((75 * cast(n as decimal(20, 0)) * {n_docs}BD) div {max(1, n_words)}BD)").cast("long")
    ready = written.where(F.size("terms") > 0).select("doc_id", length.alias("m"), "terms", "tfs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = search_rows(batches, items, weights, top)
        flat = [(names[k], doc if there else None, -score) for k, own in enumerate(best) for score, there, doc in own]
        columns = list(zip(*flat, strict=True)) if flat else [[], [], []]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["item_id", "doc_id", "score"])

    return ready.mapInArrow(run, "item_id long, doc_id long, score long")
