"""Exact deduplication with a heavy-hitter split.

Digests that a large share of all rows carry are found with Misra-Gries summaries, one per task, and counted exactly
in a second pass; the verified winners (at most ``1 / (share - 1 / (counters + 1))`` of them, a bound that does not
depend on the data) are broadcast, so their rows are settled on the map side and never travel. All other digests use
an ordinary shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.tables import SPACE, text_or_empty
from lakemart.sources.lake import Workspace

COUNTERS = 4096
SHARE = 1 / 1024


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of ASCII white space as one blank; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def misra_gries(counts: Counter, counters: int) -> Counter:
    """Shrink a summary to ``counters`` entries; every count falls by the same amount, the (counters+1)-th largest."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return Counter({key: n - cut for key, n in counts.items() if n > cut})


def summarise(digests: DataFrame, counters: int) -> DataFrame:
    """Misra-Gries summary of each task: (digest, at_least). Memory per task is bounded by batch size and counters."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for entry in batch.column("digest").value_counts().tolist():
                held[entry["values"]] += entry["counts"]
            held = misra_gries(held, counters)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(held), pa.binary()), "at_least": pa.array(list(held.values()), pa.int64())}
        )

    return digests.select("digest").mapInArrow(task, "digest binary, at_least long")


def heavy_digests(digests: DataFrame, work: Workspace, counters: int = COUNTERS, share: float = SHARE) -> DataFrame:
    """(digest, keep_id, group_size) of every digest that at least ``share`` of the rows carry, counted exactly.

    A summary undercounts by at most n / (counters + 1), so no such digest can miss the candidates.
    """
    rows = digests.count()
    sums = summarise(digests, counters).groupBy("digest").agg(F.sum("at_least").alias("at_least"))
    floor = rows * (share - 1 / (counters + 1))
    candidates = work.save(sums.where(F.col("at_least") >= max(1.0, floor)).select("digest"), "candidates")
    exact = digests.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest")
    exact = exact.agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return work.save(exact.where(F.col("group_size") >= max(2.0, share * rows)), "winners")


def exact_groups(
    docs: DataFrame, work: Workspace, counters: int = COUNTERS, share: float = SHARE, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text).

    Equal texts are those equal after white space is normalised. The smallest doc_id of a group stays; a null doc_id
    stays only if no other row has the text. Rows that repeat the doc_id that stays are marked as kept as well
    (``distinct_docs`` returns one row for them). Null texts count as empty; an empty table gives no rows. Other
    columns are ignored, except those named in ``carry``.
    """
    names = ["doc_id", *carry]
    digests = docs.select(*names, F.unhex(F.sha2(normalised(), 256)).alias("digest"))
    digests = work.save(digests, "digests")
    heavy = F.broadcast(heavy_digests(digests, work, counters, share))
    settled = digests.join(heavy, "digest", "left")
    light = digests.join(heavy.select("digest"), "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    out = settled.where(F.col("group_size").isNotNull()).select(*names, "digest", "keep_id", "group_size").unionByName(
        light.join(groups, "digest").select(*names, "digest", "keep_id", "group_size")
    )
    return out.select(
        *names,
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_docs(docs: DataFrame, work: Workspace, counters: int = COUNTERS, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that share doc_id and text, one stays.

    Rows to drop, and rows that repeat both doc_id and text, are marked in one narrow table that texts meet in one
    shuffle; it grows with the corpus and is never broadcast.
    """
    groups = exact_groups(docs, work, counters, share)
    key = ["doc_id", F.unhex("text_sha256").alias("digest")]
    lost = groups.where("not kept").select(*key, F.lit(True).alias("lost"))
    again = groups.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").select(*key, F.lit(False).alias("lost"))
    marks = work.save(lost.unionByName(again).distinct(), "marks").hint("merge")
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.sha2(normalised(), 256)).alias("hash"))
    same = rows["row.doc_id"].eqNullSafe(marks["doc_id"]) & (rows["hash"] == marks["digest"])
    rows = rows.join(marks, same, "left").where("lost is null or not lost")
    single = rows.where("lost is null").select("row.*")
    if again.isEmpty():
        return single
    doubled = rows.where("not lost").groupBy(F.col("row.doc_id").alias("id"), "hash").agg(F.min("row").alias("row"))
    return single.unionByName(doubled.select("row.*"))
