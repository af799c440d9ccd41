"""Source divergence audit: how each source's use of words differs from the other sources of its language.

Texts are lower-cased (A-Z), cut into terms, dictionary-encoded and counted by Arrow's compute functions inside
``mapInArrow``; only partial counts leave a task. Merged counts are kept as columnar shards, one row per term with the
counts of all sources beside each other, and each shard is compared as one dense matrix of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.tables import text_or_empty
from lakemart.sources.lake import Workspace

NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
ONE = 1_000_000_000
LEAST_DOCS, TOP = 3, 200
SLICE_BYTES, HELD_ROWS, SHARD_CELLS, BLOCK_CELLS = 8 << 20, 1 << 20, 1 << 18, 1 << 18

_PARTIAL = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)
_FOUND = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]
)


# ---------------------------------------------------------------- partial counts


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of at most ``most`` bytes of text; a longer text is a range of its own."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = int(edges[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(edges, done + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """lang, source, term, n (occurrences), docs (rows that hold it); a null term with zeros marks an occurring group."""
    lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
    group = pc.add(
        pc.multiply(lang.indices.cast(pa.int64()), pa.scalar(len(source.dictionary), pa.int64())), source.indices
    )
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), pattern=NOT_TERM)
    row, word = pc.list_parent_indices(words), pc.list_flatten(words)
    real = pc.not_equal(word, "")
    row, term = row.filter(real), pc.dictionary_encode(word.filter(real))
    held = pa.table({"row": row, "term": term.indices}).group_by(["row", "term"]).aggregate([([], "count_all")])
    counted = (
        pa.table({"group": group.take(held["row"].combine_chunks()), "term": held["term"], "n": held["count_all"]})
        .group_by(["group", "term"])
        .aggregate([("n", "sum"), ([], "count_all")])
    )
    seen = pc.unique(group)
    codes = pa.concat_arrays([counted["group"].combine_chunks(), seen])
    none = pa.nulls(len(seen), pa.int32())
    zeros = pa.array(np.zeros(len(seen), np.int64))
    terms = pa.concat_arrays([counted["term"].combine_chunks().cast(pa.int32()), none])
    wide = np.asarray(codes)
    return pa.Table.from_arrays(
        [
            lang.dictionary.take(pa.array(wide // len(source.dictionary))),
            source.dictionary.take(pa.array(wide % len(source.dictionary))),
            term.dictionary.take(terms),
            pa.concat_arrays([counted["n_sum"].combine_chunks(), zeros]),
            pa.concat_arrays([counted["count_all"].combine_chunks(), zeros]),
        ],
        schema=_PARTIAL,
    )


def _merged(parts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(parts)
    merged = table.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns(["lang", "source", "term", "n", "docs"]).select(_PARTIAL.names).cast(_PARTIAL)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of many batches are merged in the task; they leave it when too many rows would be held."""
    parts, rows = [], 0
    for batch in batches:
        for piece in slices(batch, "text"):
            parts.append(count_terms(piece))
            rows += len(parts[-1])
            if rows >= HELD_ROWS:
                merged = _merged(parts)
                parts, rows = [merged], len(merged)
                if rows >= HELD_ROWS // 2:
                    yield from merged.to_batches(max_chunksize=1 << 16)
                    parts, rows = [], 0
    if parts:
        yield from _merged(parts).to_batches(max_chunksize=1 << 16)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs over all rows; the row with a null term stands for the group itself."""
    texts = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source", "text")])
    partial = texts.mapInArrow(_partial_counts, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---------------------------------------------------------------- shards


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / total), exact for totals up to 9 * 10^15 (long division by thousands)."""
    if counts.size and int(counts.max()) + 1 <= (1 << 63) // ONE - 1:
        return (counts + 1) * ONE // totals + 1
    out, rest = np.zeros_like(counts), counts + 1
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + digit
    return out + 1


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _highest(values: np.ndarray, terms: list[bytes], most: int) -> list[int]:
    """Places of the ``most`` largest values, ties by ascending term."""
    places = np.arange(len(values))
    if len(values) > most:
        places = np.flatnonzero(values >= np.partition(values, len(values) - most)[len(values) - most])
    return sorted(places.tolist(), key=lambda k: (-int(values[k]), terms[k]))[:most]


def compare_shard(kept: pa.Table, groups: pa.Table, top: int = TOP) -> pa.Table:
    """Sums of f for all pairs of sources over the shard's terms, and each source's highest terms in the shard."""
    order = np.argsort(np.array(groups["source"].to_pylist(), object))
    sources = [groups["source"][int(k)].as_py() for k in order]
    n_terms = int(groups["n_terms"][0].as_py())
    totals = groups["total"].to_numpy()[order].astype(np.int64)
    summed, n = np.zeros((len(sources), len(sources)), np.int64), len(sources)
    place = {s: k for k, s in enumerate(sources)}
    found: list[tuple[str, str, int]] = []
    best: list[list[tuple[int, bytes]]] = [[] for _ in sources]
    step = max(1, BLOCK_CELLS // max(1, n))
    for start in range(0, len(kept), step):
        block = kept.slice(start, step)
        terms = [t.encode("utf-8", "surrogatepass") for t in block["term"].to_pylist()]
        lists = block["counts"].combine_chunks()
        pairs = lists.flatten()
        codes = pc.dictionary_encode(pairs.field("source"))
        column = np.array([place[s] for s in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]
        counts = np.zeros((len(block), n), np.int64)
        counts[pc.list_parent_indices(lists).to_numpy(), column] = pairs.field("n").to_numpy()
        p = shares(counts, totals + n_terms)
        q = shares(counts.sum(axis=1), totals.sum() + n_terms)
        for s in range(n):
            summed[s] += _far(p[:, s : s + 1], p).sum(axis=0)
            here = np.flatnonzero((counts[:, s] > 0) & (p[:, s] > q))
            values = _far(p[here, s], q[here])
            names = [terms[k] for k in here]
            best[s] += [(-int(values[k]), names[k]) for k in _highest(values, names, top)]
            best[s] = sorted(best[s])[:top]
    rows = []
    for s, source in enumerate(sources):
        rows += [(source, "pair", sources[t], int(summed[s, t])) for t in range(n) if t != s]
        rows += [(source, "term", term.decode("utf-8", "surrogatepass"), -value) for value, term in best[s]]
    lang = groups["lang"][0].as_py()
    columns = list(zip(*[(lang, *r) for r in rows], strict=True)) if rows else [[]] * 5
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)


def _compare(kept: pa.Table, groups: pa.Table) -> pa.Table:
    return compare_shard(kept, groups) if len(groups) else _FOUND.empty_table()


def audit(docs: DataFrame, work: Workspace, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has every other source of the language, ``term`` the 200
    terms that a source uses most beyond its language.

    Each language keeps the terms that at least ``least_docs`` of its rows hold. With p and q = 1 + floor(10^9 * (n +
    1) / (N + V)), f = floor((p - q)^2 / q); a pair's value is the sum of f over all V kept terms, a term's value is
    its f against the whole language where p > q. Everything is whole-number arithmetic; a sum of f stays below
    (10^9 + V)^2, so it fits a long up to two billion kept terms a language.

    Null text, lang and source count as empty texts; rows are the documents, so repeated rows and ids count again. A
    group without terms has pairs and no term rows, and so has every group of a language that keeps no term (value 0).
    Ties go by ascending UTF-8. An empty table gives no rows. Other columns are not read.
    """
    counts = work.save(term_counts(docs), "term_counts")
    merged = counts.where("term is not null").groupBy("lang", "term").agg(
        F.collect_list(F.struct("source", "n")).alias("counts"), F.sum("docs").alias("docs")
    )
    kept = work.save(merged.where(F.col("docs") >= least_docs).drop("docs"), "kept_terms")
    totals = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left")
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms")), "lang", "left").select(
        "lang",
        F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        F.ceil(F.greatest(F.coalesce("n_terms", F.lit(0)) * F.col("n_sources") / SHARD_CELLS, F.lit(1)))
        .cast("int")
        .alias("n_shards"),
    )
    langs = work.save(langs, "languages")
    groups = work.save(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "groups")
    sharded = kept.join(langs, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("n_shards").cast("long")).alias("shard"), "term", "counts"
    )
    beside = groups.join(langs, "lang").select(
        "lang", "source", "total", "n_terms", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("shard")
    )
    beside = beside.withColumn("shard", F.col("shard").cast("long"))
    found = work.save(
        sharded.groupBy("lang", "shard")
        .cogroup(beside.groupBy("lang", "shard"))
        .applyInArrow(_compare, "lang string, source string, part string, item string, value long"),
        "shard_results",
    )
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked)
    terms = found.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP)
    return pairs.withColumn("rank", rank).unionByName(terms)
