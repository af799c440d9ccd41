"""Mixing sources to target weights by repetition.

Word counts are summed per source, weights and caps give each source a target, and target / size is the repetition
rate of its documents: every document is emitted floor(rate) times, plus one copy drawn with the fraction as
probability. The draw is a hash of seed and doc_id, so reruns agree. One pass sums, for a few seeds at once, what each
would take; every source then uses the seed that comes closest to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.tables import WORD, running_total, text_or_empty
from lakemart.sources.lake import Workspace

SEEDS = 16


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def draw(doc_id: str | Column, seed: int | Column) -> Column:
    """Number in [0, 1) from the first 48 bits of md5(seed, doc_id); a null doc_id draws as the text ``null``."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    seed = F.lit(seed) if isinstance(seed, int) else seed
    key = F.concat_ws(":", seed.cast("string"), F.coalesce(column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_totals(sized: DataFrame) -> DataFrame:
    """Words per source; the null source is a group of its own."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(totals: DataFrame, weights: Sequence[float], work: Workspace) -> DataFrame:
    """Give the sources, by code point and null last, the weights in turn."""
    keyed = totals.select(
        "*", F.col("source").isNull().alias("_none"), F.lit(1).alias("_one")
    )
    ranked = running_total(keyed, ["_none", "source"], "_one", "_rank", work, "ranks")
    which = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", which).drop("_none", "_one", "_rank")


def targets(totals: DataFrame, share: float, cap: float, work: Workspace) -> DataFrame:
    """Add ``target``: ``share`` of all words dealt by weight, at most ``cap`` times a source's words.

    What capped sources cannot take is dealt among the others by weight until none is above its cap. Each round is
    one aggregate over the sources; it ends when no further source reaches its cap.
    """
    totals = work.save(totals, "totals")
    limit = F.lit(float(cap)) * F.col("source_size")
    all_words = totals.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else (F.col("weight") * F.lit(level) >= limit)
        row = totals.agg(
            F.sum(F.when(full, limit).otherwise(0.0)).alias("used"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("weight"),
            F.sum(full.cast("long")).alias("capped"),
        ).first()
        if not row["weight"] or row["capped"] == capped:
            break
        level, capped = (share * all_words - row["used"]) / row["weight"], row["capped"]
    wanted = limit if level is None else F.least(limit, F.col("weight") * F.lit(level))
    return totals.withColumn("target", wanted)


def mix(
    docs: DataFrame,
    work: Workspace,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seeds: int = SEEDS,
) -> DataFrame:
    """doc_id, size, source, source_size, target, rate, copies, taken for every row of ``docs``.

    Null texts have size 0 and are taken zero times; so are all rows of a source without words. Rows with equal
    doc_id draw alike. An empty table gives no rows. Rates never exceed ``cap``.
    """
    sized = work.save(docs.select("doc_id", "source", word_count().alias("size")), "sized")
    plan = targets(cyclic_weights(source_totals(sized), weights, work), share, cap, work)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = work.save(plan.select("source", "source_size", "target", rate.alias("rate")), "plan")
    rated = _join_source(sized, plan)
    extra = F.col("rate") - F.floor("rate")
    takes = [F.sum(F.when(draw("doc_id", s) < extra, F.col("size")).otherwise(0)).alias(f"_t{s}") for s in range(seeds)]
    tried = rated.groupBy("source").agg(F.first("target").alias("target"), F.first("rate").alias("rate"),
                                        F.sum("size").alias("n"), *takes)
    off = [
        F.struct(
            F.abs(F.floor("rate") * F.col("n") + F.col(f"_t{s}") - F.col("target")).alias("off"), F.lit(s).alias("seed")
        )
        for s in range(seeds)
    ]
    best = tried.select("source", F.array_min(F.array(*off))["seed"].alias("seed"))
    plan = work.save(_join_source(plan, best), "seeded")
    copies = F.floor("rate") + (draw("doc_id", F.col("seed")) < extra).cast("long")
    return _join_source(sized, plan).select(
        "doc_id", "size", "source", "source_size", "target", "rate", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def _join_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Join on source with null equal to null. The source side is small or large as the data has it: Spark decides.

    AQE splits a source that holds much of the rows, because nothing above the join needs them together.
    """
    right = sources.withColumnRenamed("source", "_source")
    return rows.join(right, rows["source"].eqNullSafe(right["_source"])).drop("_source")


def mixed_docs(docs: DataFrame, work: Workspace, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    The copies of a row are made in place from its own doc_id, source and text, so texts are not shuffled.
    """
    mix(docs, work, **options)  # writes the plan per source
    plan = work.spark.read.parquet(work.path("seeded"))
    rows = docs.select(F.struct("*").alias("row"))
    right = plan.select(F.col("source").alias("_source"), F.col("rate"), F.col("seed"))
    joined = rows.join(right, rows["row.source"].eqNullSafe(right["_source"]))
    extra = (draw(F.col("row.doc_id"), F.col("seed")) < F.col("rate") - F.floor("rate")).cast("long")
    times = F.when(word_count(F.col("row.text")) > 0, F.floor("rate") + extra).otherwise(F.lit(0)).cast("int")
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
