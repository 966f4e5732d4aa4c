"""Quality scores by positive-unlabelled learning.

A document is described by the shares of its character classes and of pairs of neighbouring classes, and by how often
a word repeats the one before. A logistic model minimises the non-negative unbiased risk: trusted positives carry the
positive loss, unlabelled web text the negative loss, from which the positives' part, weighted by the class prior, is
taken away, but never below zero. The prior is estimated from all documents: a first model, fitted on half of the
positives, tells positives from unlabelled text, and the least ratio between the unlabelled share and the other
half's share above a threshold bounds it.

Only quality labels equal to 1 are used, none of them from a held-out row. Null text is an empty text, which is scored
like any other. Labels of null, or of documents that don't occur, count for nothing; a document labelled more than
once is a positive once. Without any positive there is no model and every score is 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.llm.shared import id_and_text, map_slices, quoted, saved

FIT_POSITIVES, FIT_UNLABELLED = 6_000, 12_000  # most rows that the model is fitted on
HELD_OUT_FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
BINS = 2000  # of the first model's scores, for the prior
STEPS, RATE, RIDGE = 800, 0.05, 3e-3

_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r\t", ".,;:", "!?", "|", "#$%&*@^~",
           "\"'()[]{}<>-/_=+\\`")


def _classes() -> np.ndarray:
    table = np.full(256, len(_GROUPS), np.uint8)  # other control characters
    for k, characters in enumerate(_GROUPS):
        table[np.frombuffer(characters.encode(), np.uint8)] = k
    table[128:] = len(_GROUPS) + 1
    return table


CLASSES = _classes()
N_CLASSES = len(_GROUPS) + 2
N_FEATURES = N_CLASSES + N_CLASSES * N_CLASSES + 1
PRIOR_COUNT = 20.0  # added to every length, so that shares of a few characters stay small


def features(text: str | None) -> np.ndarray:
    """Class shares, class-pair shares, and the share of words that repeat their predecessor."""
    kinds = CLASSES[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    singles = np.bincount(kinds, minlength=N_CLASSES)
    pairs = np.bincount(kinds[:-1] * np.uint8(N_CLASSES) + kinds[1:], minlength=N_CLASSES * N_CLASSES)
    words = (text or "").split()
    repeats = sum(map(str.__eq__, words, words[1:]))
    shares = np.concatenate([singles, pairs]) / (len(kinds) + PRIOR_COUNT)
    return np.append(shares, repeats / (len(words) + PRIOR_COUNT / 5)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights over standardised features; ``prior`` is the estimated share of positives."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((rows - self.centre) / self.scale, -8, 8) @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == HELD_OUT, F.lit(False))


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk; without a prior, on the plain loss of positives against unlabelled rows."""
    n = positive.shape[1]
    parameters, first, second = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)

    def mean_gradient(rows: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(rows.T @ slope, slope.sum()) / len(rows)

    for step in range(1, STEPS + 1):
        p, u = _sigmoid(positive @ parameters[:-1] + parameters[-1]), _sigmoid(unlabelled @ parameters[:-1] + parameters[-1])
        as_positive, p_negative, u_negative = mean_gradient(positive, p - 1), mean_gradient(positive, p), mean_gradient(unlabelled, u)
        if prior is None:
            gradient = as_positive + u_negative
        else:
            risk = -np.log(np.maximum(1 - u, 1e-12)).mean() + prior * np.log(np.maximum(1 - p, 1e-12)).mean()
            negative = u_negative - prior * p_negative
            gradient = prior * as_positive + negative if risk >= 0 else -negative
        gradient = gradient + RIDGE * np.append(parameters[:-1], 0)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        rate = RATE * (1 - step / (STEPS + 1))
        parameters = parameters - rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return parameters[:-1], float(parameters[-1])


def _scored(described: DataFrame, model: Model) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.asarray(batch.column(0).flatten()).reshape(-1, N_FEATURES)
        return pa.RecordBatch.from_arrays([pa.array(model.scores(rows), pa.float64()), batch.column(1)], ["score", "positive"])

    return map_slices(described.select("features", F.col("positive") & ~F.col("half")), work, "score double, positive boolean")


def estimated_prior(described: DataFrame, model: Model) -> float:
    """From the first model's scores of all rows, by bin: the least (share of all above) / (share of positives above)."""
    bins = (_scored(described, model).select(F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin"), "positive")
            .groupBy("bin").agg(F.count("*").alias("n"), F.count_if("positive").alias("p")).collect())
    counts = np.zeros((BINS, 2))
    for row in bins:
        counts[row["bin"]] += row["n"], row["p"]
    above = counts[::-1].cumsum(0)
    shares = above / np.maximum(above[-1], 1)
    enough = shares[:, 1] >= 0.5
    return float(np.clip((shares[enough, 0] / shares[enough, 1]).min(initial=1.0), 0.05, 0.99))


def _sample(rows: DataFrame, limit: int) -> np.ndarray:
    """Rows drawn one by one, so that copies of a text take part by their share: the same ones on every run over the same files."""
    kept = rows.orderBy("key", "doc_id").limit(limit).select("features").toPandas()["features"]
    return np.stack(kept.tolist()).astype(np.float64) if len(kept) else np.zeros((0, N_FEATURES))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model | None:
    """The model, or None if there is no positive. At most FIT_POSITIVES and FIT_UNLABELLED rows reach the fit."""

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [features(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], ["doc_id", "features"])

    learnable = id_and_text(docs, id_column, text_column).where(~held_out(F.col("doc_id")))
    positives = (labels.where(quoted("quality") == 1).select(quoted("doc_id").cast("bigint").alias("doc_id")).distinct()
                 .withColumn("positive", F.lit(True)))
    described = saved(map_slices(learnable, describe, "doc_id bigint, features array<float>")
                      .withColumn("key", F.xxhash64("doc_id", F.monotonically_increasing_id()))  # repeated and missing ids are told apart
                      .join(positives, "doc_id", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))
                      .withColumn("half", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(2)) == 0), "quality-features")
    halves = [_sample(described.where(F.col("positive") & (F.col("half") == first)), FIT_POSITIVES // 2) for first in (True, False)]
    positive, unlabelled = np.concatenate(halves), _sample(described, FIT_UNLABELLED)
    if not len(positive):
        return None
    centre, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    h, p, u = (np.clip((x - centre) / scale, -8, 8) for x in (halves[0] if len(halves[0]) else positive, positive, unlabelled))
    prior = estimated_prior(described, Model(centre, scale, *_descend(h, u, None), 0.0))
    return Model(centre, scale, *_descend(p, u, prior), prior)


def _scores(texts: list[str | None], model: Model | None) -> np.ndarray:
    if model is None or not texts:
        return np.ones(len(texts))
    return model.scores(np.stack([features(t) for t in texts]))


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score and predicted."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(batch.column(1).to_pylist(), model), pa.float64())], ["doc_id", "score"])

    scored = map_slices(id_and_text(docs, id_column, text_column), work, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts to be of quality, unchanged."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_scores(batch.column(batch.schema.get_field_index(text_column)).to_pylist(), model) >= THRESHOLD))

    return map_slices(docs, work, docs.schema)
