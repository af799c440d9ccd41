"""Training-corpus pipeline: documents in, encoded training documents out.

Every stage takes the rows that the one before kept and returns rows with the columns of ``documents``; the last one
returns token ids. All stages take rows with any further columns, also ones named like an operator's own, and an empty
table, which stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import exact_dedup, minhash, mixing, nbest, quality
from lakemart.llm.tables import table, workspace

NEAR = 80
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that the classifier rejects go; it learns from the labels of the same folder.

    Null texts are judged as empty ones, rows with equal texts alike, whatever their doc_id or other columns hold.
    """
    workspace(spark)
    return quality.good_docs(docs, quality.train(docs, table(spark, folder, "labels")))


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the smallest doc_id (nulls last).

    Null, empty and blank texts are one group. Of rows that also repeat the doc_id any one stays.
    """
    return exact_dedup.distinct_docs(docs, workspace(spark))


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near duplicates (similarity ``NEAR`` percent or more) stays.

    It is that of the smallest doc_id (nulls last), and of its texts the one with the smallest set fingerprint. Rows
    without words are near nothing and all stay.
    """
    return minhash.distinct_docs(docs, workspace(spark), NEAR)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every row as often as its source's weight asks for; rows without words are taken zero times.

    The null source is a source of its own. Rows with equal doc_id draw alike, and null doc_ids like the text ``null``.
    """
    return mixing.mixed_docs(docs, workspace(spark))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, lang, source, ids and n_pieces of the best segmentation, scores of the n best.

    One row per row; null and empty texts have no ids and the one score 0.
    """
    import public_tokenizers

    workspace(spark)
    found = nbest.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=("lang", "source"))
    return found.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_pieces"), "scores")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written, and read again by the next."""
    work = workspace(spark)
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, folder), name)
        if before:
            work.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, folder)
