"""Quality classifier by positive-unlabelled learning.

A linear model over hashed byte trigrams and a few shares (letters, capitals, symbols, repeated words ...) minimises
the non-negative unbiased risk: trusted positives, unlabelled web text and an estimated class prior; labelled
negatives are never shown to it. The fit runs on a bounded sample in the driver, scoring on all rows in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.hashing import piece_hashes, utf8
from lakemart.llm.held import release

SAMPLE = 10_000
PIECES = 1 << 16
TRIGRAMS = 512
SHARES = 12
CUTOFF = 0.7
LOSS, MOST_SHIFT = 0.0015, 2.5
_CLASS = np.zeros(256, np.uint8)  # 0 symbol, 1 lower, 2 upper, 3 digit, 4 blank, 5 line end, 6 beyond ASCII, 7 full stop or comma
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[9, 11, 12, 32]], _CLASS[[10, 13]], _CLASS[128:], _CLASS[[44, 46]] = 4, 5, 6, 7


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id's text leaves 2 by 4."""
    text = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text, of fixed width; all texts are read to their end, in pieces."""
    out = np.zeros((len(texts), TRIGRAMS + SHARES), np.float32)
    words, counts = piece_hashes(texts)
    ends = np.cumsum(counts)
    for i, text in enumerate(texts):
        grams, classes = np.zeros(TRIGRAMS, np.int64), np.zeros(8, np.int64)
        for at in range(0, len(text), PIECES):
            part = np.frombuffer(text, np.uint8, min(PIECES + 2, len(text) - at), at).astype(np.uint32)
            classes += np.bincount(_CLASS[part[:PIECES]], minlength=8)
            if len(part) > 2:
                code = part[:-2] * np.uint32(0x9E3779B1) + part[1:-1] * np.uint32(0x85EBCA6B) + part[2:] * np.uint32(0xC2B2AE35)
                grams += np.bincount(code >> np.uint32(23), minlength=TRIGRAMS)
        total = max(1, len(text))
        own = words[ends[i] - counts[i] : ends[i]]
        out[i, :TRIGRAMS] = np.sqrt(grams / total)
        out[i, TRIGRAMS : TRIGRAMS + 8] = classes / total
        out[i, TRIGRAMS + 8] = (own[1:] == own[:-1]).mean() if len(own) > 1 else 0
        out[i, TRIGRAMS + 9] = len(np.unique(own)) / len(own) if len(own) else 0
        out[i, TRIGRAMS + 10] = min(total / max(1, len(own)) / 20, 5)
        out[i, TRIGRAMS + 11] = np.log1p(len(own)) / 10
    return out


@dataclass(frozen=True)
class Model:
    """score = sigmoid(weights . (x - mean) / scale + bias); without weights the score is 1."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        margin = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -30, 30)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 60, batch: int = 512) -> Model:
    """Minimise prior * R+(P) + max(0, R-(U) - prior * R-(P)) with the logistic loss.

    Where a batch's negative part falls below zero, the step goes the other way on that part alone, so the model
    cannot buy a lower risk by overfitting the positives.
    """
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    rng = np.random.default_rng(7)
    width = p.shape[1]
    theta, first, second, step = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1), 0

    def margin(x: np.ndarray) -> np.ndarray:
        return np.clip(x @ theta[:-1] + theta[-1], -30, 30)

    for epoch in range(epochs):
        rate = 0.02 * 0.95**epoch
        order_p, order_u = rng.permutation(len(p)), rng.permutation(len(u))
        for k in range(max(1, len(u) // batch)):
            xp = p[np.take(order_p, range(k * batch, (k + 1) * batch), mode="wrap")]
            xu = u[np.take(order_u, range(k * batch, (k + 1) * batch), mode="wrap")]
            sp, su = 1 / (1 + np.exp(-margin(xp))), 1 / (1 + np.exp(-margin(xu)))
            negative = -np.log(1 - su + 1e-9).mean() - prior * -np.log(1 - sp + 1e-9).mean()
            down = su / len(su), -prior * sp / len(sp)  # slopes of the negative part
            if negative >= 0:
                weights_p, weights_u = prior * (sp - 1) / len(sp) + down[1], down[0]
            else:
                weights_p, weights_u = -down[1], -down[0]
            slope = np.append(xp.T @ weights_p + xu.T @ weights_u, weights_p.sum() + weights_u.sum())
            slope[:-1] += 1e-4 * theta[:-1]
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[:-1].astype(np.float32), float(theta[-1]))


def fit_calibrated(positive: np.ndarray, unlabelled: np.ndarray, prior: float, cutoff: float = CUTOFF) -> Model:
    """Fit on all positives, with the bias raised so far that the cutoff loses few positives.

    A fit that leaves out every fifth positive shows which margin all but ``LOSS`` of unseen positives reach; if that
    lies below the cutoff, the bias makes up for the difference, by ``MOST_SHIFT`` at most.
    """
    model = fit_nnpu(positive, unlabelled, prior)
    apart = np.arange(len(positive)) % 5 == 0
    if apart.sum() < 20:
        return model
    trial = fit_nnpu(positive[~apart], unlabelled, prior).score(positive[apart])
    low = float(np.quantile(np.log(trial / (1 - trial)), LOSS))
    return replace(model, bias=model.bias + min(MOST_SHIFT, max(0.0, np.log(cutoff / (1 - cutoff)) - low)))


def _sample_features(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of the documents with these (bounded, sampled) ids, collected as one array, one row for each id.

    Of rows that repeat an id the one whose text has the smallest hash counts, so the bound holds whatever repeats.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = features(utf8(batch.slice(at, 256).column("text").to_pylist()))
                yield pa.RecordBatch.from_pydict({"x": pa.array([row.tobytes() for row in found], pa.binary())})

    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = texts.select("text").mapInArrow(task, "x binary").toArrow().column("x").to_pylist()
    return np.frombuffer(b"".join(sorted(rows)), np.float32).reshape(-1, TRIGRAMS + SHARES)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` trusted positives and as many unlabelled documents, chosen by hash of the id.

    Held-out rows are neither. The prior is the share of positives among the labelled rows that may be learned from.
    Without positives or unlabelled documents nothing is learned (``Model()``); if every document is labelled, the
    training documents serve as unlabelled ones.
    """
    ids = docs.select(F.col("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out())
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("quality") == 1).cast("long")).alias("good")).first()
    if not counts["good"]:
        return Model()
    prior = min(0.99, counts["good"] / counts["n"])

    def some(frame: DataFrame) -> DataFrame:
        chosen = frame.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        return docs.sparkSession.createDataFrame(chosen.toArrow())

    free = ids.join(labels.select("doc_id"), "doc_id", "left_anti")
    positive = _sample_features(docs, some(known.where("quality = 1")))
    unlabelled = _sample_features(docs, some(free))
    if not len(unlabelled):
        unlabelled = _sample_features(docs, some(ids))
    if not len(positive) or not len(unlabelled):
        return Model()
    return fit_calibrated(positive, unlabelled, prior)


def score(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text).

    Null texts count as empty and are scored like empty ones; rows with equal texts score alike, whatever else they
    hold; an empty table gives no rows; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = model.score(features(utf8(part.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    scored = rows.mapInArrow(task, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def good_docs(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``cutoff``, with all their columns; nothing is shuffled."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        release()
        parts = [model.score(features(utf8(texts[i : i + 256]))) for i in range(0, len(texts), 256)]
        return pd.Series(np.concatenate([np.empty(0), *parts]))

    return docs.where(scores(F.coalesce("text", F.lit(""))) >= cutoff)
