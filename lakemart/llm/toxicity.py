"""Toxicity categories by a chain of linear classifiers.

The categories are learned in order. Every model sees hashed words and beginnings of words and, for all categories before its own, the
probabilities that earlier models give. In training these probabilities are out-of-fold: each comes from a model that
did not see the row, so later models learn from errors like those they will meet. The fit runs on a bounded sample in
the driver, scoring on all rows in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.hashing import lut, mix, piece_hashes, utf8
from lakemart.llm.quality import held_out

SAMPLE = 8_000
MOST_BUCKETS = 4_096
BUCKET_BITS = 18
SELECTED = 2_000
LEAST_DOCS = 5
FOLDS = 4
BEGINNINGS = (4, 5)
CATEGORIES = ("toxic", "severe", "broad")
_NO_LETTER = lut(bytes(c for c in range(128) if not chr(c).isalpha()))


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each text with their counts, the number of buckets and of words of each text.

    Every word has a bucket, and so has each of its beginnings, which words of one root share.
    """
    words, counts = piece_hashes(texts, _NO_LETTER)
    rows = np.repeat(np.arange(len(texts)), counts)
    hashes = [words, *[piece_hashes(texts, _NO_LETTER, most=n)[0] ^ np.uint64(n << 40) for n in BEGINNINGS]]
    places = [(rows << BUCKET_BITS) | (mix(h) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) for h in hashes]
    codes, times = np.unique(np.concatenate(places), return_counts=True)
    own = np.bincount(codes >> BUCKET_BITS, minlength=len(texts))
    return (codes & ((1 << BUCKET_BITS) - 1)).astype(np.int32), times, own, counts


@dataclass(frozen=True)
class Rows:
    """Sparse presence matrix: columns of row i are ``columns[starts[i]:starts[i + 1]]``."""

    columns: np.ndarray
    starts: np.ndarray

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def take(self, keep: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[keep]
        return Rows(self.columns[np.repeat(keep, np.diff(self.starts))], np.append(0, np.cumsum(sizes)))

    def take_used(self) -> Rows:
        """Without the entries that have no column."""
        used = self.columns >= 0
        sizes = np.bincount(self.owners[used], minlength=len(self.starts) - 1)
        return Rows(self.columns[used], np.append(0, np.cumsum(sizes)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)) / 5


def margins(rows: Rows, extra: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    n = len(rows.starts) - 1
    width = len(weights) - extra.shape[1]
    return np.bincount(rows.owners, weights[:width][rows.columns], n) + extra @ weights[width:] + bias


def fit_linear(rows: Rows, extra: np.ndarray, y: np.ndarray, width: int, steps: int = 250) -> tuple[np.ndarray, float]:
    """Logistic regression with a small ridge; the classes weigh alike. One class only: a constant."""
    n = len(y)
    if not n or y.min() == y.max():
        return np.zeros(width + extra.shape[1]), 8.0 if n and y.max() else -8.0
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    owners = rows.owners
    theta, first, second = (np.zeros(width + extra.shape[1] + 1) for _ in range(3))
    for step in range(1, steps + 1):
        z = np.bincount(owners, theta[:width][rows.columns], n) + extra @ theta[width:-1] + theta[-1]
        residual = balance * (_sigmoid(z) - y) / n
        slope = np.concatenate([np.bincount(rows.columns, residual[owners], width), extra.T @ residual, [residual.sum()]])
        slope[:-1] += 2e-4 * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta -= 0.2 * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


@dataclass(frozen=True)
class Chain:
    """Models of the categories in order; ``place`` maps a bucket to its column, -1 where it is not used."""

    categories: tuple[str, ...]
    place: np.ndarray
    models: tuple[tuple[np.ndarray, float], ...]

    def predict(self, texts: list[bytes]) -> np.ndarray:
        found, _, own, _ = buckets(texts)
        columns = self.place[found]
        rows = Rows(columns, np.append(0, np.cumsum(own))).take_used()
        extra = np.zeros((len(texts), 0))
        out = np.zeros((len(texts), len(self.categories)))
        for k, (weights, bias) in enumerate(self.models):
            out[:, k] = _sigmoid(margins(rows, extra, weights, bias))
            extra = np.column_stack([extra, _logit(out[:, k])])
        return out


def select(rows: Rows, y: np.ndarray, most: int = SELECTED) -> np.ndarray:
    """The buckets whose presence tells most about ``y`` (chi-square), among those in enough rows."""
    width = 1 << BUCKET_BITS
    seen = np.bincount(rows.columns, minlength=width)
    hits = np.bincount(rows.columns, y[rows.owners], width)
    rate = y.mean()
    wanted = seen * rate
    chi = np.where(seen >= LEAST_DOCS, (hits - wanted) ** 2 / np.maximum(wanted * (1 - rate), 1e-9), 0)
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(best[chi[best] > 0])


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The margin that splits the rows with the fewest errors; of several, the middle one. 0 if there is one class."""
    if not len(y) or y.min() == y.max():
        return 0.0
    order = np.argsort(z, kind="stable")
    errors = np.append(0, np.cumsum(y[order])) + np.append(np.cumsum(1 - y[order][::-1])[::-1], 0)
    edges = np.concatenate([[z.min() - 1], (z[order][1:] + z[order][:-1]) / 2, [z.max() + 1]])
    return float(np.median(edges[errors == errors.min()]))


def fit_chain(rows: Rows, targets: dict[str, np.ndarray], folds: np.ndarray) -> Chain:
    """Fit the categories in the order of ``targets``; ``folds`` numbers the out-of-fold part of each row."""
    first = next(iter(targets.values()))
    chosen = select(rows, first) if len(first) else np.empty(0, np.int64)
    place = np.full(1 << BUCKET_BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    used = Rows(place[rows.columns], rows.starts).take_used()
    extra = np.zeros((len(first), 0))
    models = []
    for y in targets.values():
        outside = np.zeros(len(y))
        for fold in np.unique(folds):
            rest = folds != fold
            weights, bias = fit_linear(used.take(rest), extra[rest], y[rest], len(chosen))
            outside[~rest] = margins(used.take(~rest), extra[~rest], weights, bias)
        cut = best_cut(outside, y)  # a probability of one half is where unseen rows are split best
        weights, bias = fit_linear(used, extra, y, len(chosen))
        models.append((weights, bias - cut))
        extra = np.column_stack([extra, _logit(_sigmoid(outside - cut))])
    return Chain(tuple(targets), place, tuple(models))


def degrees(rows: Rows, times: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Categories of the toxic rows by what they hold: severe ones repeat telling words, broad ones use many.

    A bucket is telling if at least nine in ten of its rows are toxic. The thresholds are the medians of toxic rows.
    """
    width = 1 << BUCKET_BITS
    seen = np.bincount(rows.columns, minlength=width)
    hits = np.bincount(rows.columns, toxic[rows.owners], width)
    telling = (seen >= LEAST_DOCS) & (hits >= 0.9 * seen) & (toxic.mean() < 0.9 if len(toxic) else False)
    mark = telling[rows.columns]
    n = len(toxic)
    dose = np.bincount(rows.owners, mark * times, n) / np.maximum(words, 1)
    kinds = np.bincount(rows.owners, mark, n)
    bad = toxic == 1
    if not bad.any():
        return {"toxic": toxic, "severe": toxic, "broad": toxic}
    return {
        "toxic": toxic,
        "severe": (bad & (dose > np.median(dose[bad]))).astype(float),
        "broad": (bad & (kinds > np.median(kinds[bad]))).astype(float),
    }


def bounded(
    found: np.ndarray, times: np.ndarray, own: Sequence[int], words: Sequence[int], most: int | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, Sequence[int]]:
    """What ``buckets`` returns, with at most ``most`` buckets a text."""
    most = most or MOST_BUCKETS
    own = np.asarray(own, np.int64)
    if not len(own) or own.max() <= most:
        return found, times, own, words
    keep = np.ones(len(found), bool)
    ends = np.cumsum(own)
    for end, n in zip(ends[own > most].tolist(), own[own > most].tolist(), strict=True):
        order = np.lexsort((found[end - n : end], -times[end - n : end].astype(np.int64)))
        keep[end - n + order[most:]] = False
    return found[keep], times[keep], np.minimum(own, most), words


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Fit the chain on at most ``sample`` labelled documents, half of them toxic where there are so many.

    They are chosen by hash of the id; held-out rows are never learned from. Of rows that repeat an id the one whose
    text has the smallest hash counts, and of a text with more than ``MOST_BUCKETS`` different buckets the most frequent
    ones (at ties the smaller numbers), so what the driver fits on is bounded in bytes. Scores read whole texts. Without
    labelled rows all scores are close to 0.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    half = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for t in (0, 1)]
    chosen = docs.sparkSession.createDataFrame(half[0].unionByName(half[1]).toArrow())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found, times, own, words = bounded(*buckets(utf8(part.column("text").to_pylist())))
                ends = np.cumsum(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("toxic").cast(pa.int64()),
                        pa.array(words, pa.int64()),
                        pa.array([found[b - n : b].tobytes() for b, n in zip(ends, own, strict=True)], pa.binary()),
                        pa.array([np.minimum(times[b - n : b], 65535).astype(np.uint16).tobytes() for b, n in zip(ends, own, strict=True)], pa.binary()),
                    ],
                    ["doc_id", "toxic", "words", "found", "times"],
                )

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    schema = "doc_id long, toxic long, words long, found binary, times binary"
    got = texts.select("doc_id", "toxic", "text").mapInArrow(task, schema).toPandas()
    got = got.sort_values(["doc_id", "words", "found"], ignore_index=True)
    owners = np.repeat(np.arange(len(got), dtype=np.int32), [len(x) // 4 for x in got["found"]])
    columns, times = np.frombuffer(b"".join(got["found"]), np.int32), np.frombuffer(b"".join(got["times"]), np.uint16)
    often = np.bincount(columns, minlength=1 << BUCKET_BITS)[columns] >= LEAST_DOCS  # the others are never selected
    times = times[often].astype(np.float32)
    rows = Rows(columns[often], np.append(0, np.cumsum(np.bincount(owners[often], minlength=len(got)))))
    toxic = (got["toxic"].to_numpy() == 1).astype(np.float64)
    targets = degrees(rows, times, got["words"].to_numpy(), toxic)
    return fit_chain(rows, targets, np.arange(len(toxic)) % FOLDS)


def score(docs: DataFrame, chain: Chain, cutoff: float = 0.5) -> DataFrame:
    """doc_id, held_out, a score per category, and ``predicted`` (1 if the first category reaches the cutoff).

    One row per row of ``docs`` (doc_id, text); null, empty and wordless texts get the scores of a text without
    words; an empty table gives no rows; other columns are ignored.
    """
    names = [f"{c}_score" for c in chain.categories]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = chain.predict(utf8(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), *[pa.array(c, pa.float64()) for c in scores.T]],
                    ["doc_id", "held_out", *names],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    schema = ", ".join(["doc_id long", "held_out boolean", *[f"{n} double" for n in names]])
    return rows.mapInArrow(task, schema).withColumn("predicted", (F.col(names[0]) >= cutoff).cast("int"))
