"""A quality classifier from trusted positives and unlabelled text (non-negative PU learning).

The model is linear in bounded features of the text and has squared loss, so
the risk over any number of documents is a function of first and second moments:
one pass over all documents gives them, and fitting needs nothing else.  With
class prior ``pi``, positives P and unlabelled text U the risk is

    pi E_P[l(g, +1)] + max(0, E_U[l(g, -1)] - pi E_P[l(g, -1)]),  l(g, y) = (1 - y g)^2 / 4.

Labels of the negative class are never used.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land, spare_name

FEATURES = (
    "length", "word_length", "upper", "symbols", "exclamations", "bars", "digits", "distinct_words",
    "repeated_lines", "sentence_ends", "commas", "repeated_pairs",
)
KNOTS = 6
#: Share of the positives that a score region must hold to bound the class prior.
PRIOR_SUPPORT = 0.5
BINS = 200

_SYMBOLS = np.frombuffer(b"#*$%&<>@^~_=+{}[]\\", np.uint8)
_ENDS = np.frombuffer(b".?", np.uint8)


def describe(text: str | None) -> list[float]:
    """The features of one whole text, each between 0 and 1; all 0 without a word."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    lines = [line for line in text.split("\n") if line.strip()]
    values = (
        np.log1p(n) / 12,
        sum(map(len, words)) / n / 20,
        upper / max(1, upper + lower),
        counts[_SYMBOLS].sum() / n,
        counts[33] / n,
        counts[124] / n,
        counts[48:58].sum() / n / 2,
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        counts[_ENDS].sum() / n,
        counts[44] / n,
        1 - len(set(zip(words, words[1:]))) / max(1, n - 1),
    )
    return [float(min(1.0, v)) for v in values]


def features(text: Column) -> Column:
    """``describe`` as a column; only the text goes to Python, in Arrow batches."""

    @F.arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([describe(t.as_py()) for t in texts], pa.list_(pa.float32()))

    return run(text)


def expand(rows: np.ndarray) -> np.ndarray:
    """Piecewise linear basis: a constant, and for each feature the hats around knots on its square root."""
    at = np.sqrt(rows)[:, :, None] * (KNOTS - 1)
    hats = np.maximum(0, 1 - np.abs(at - np.arange(KNOTS)))
    return np.concatenate([np.ones((len(rows), 1)), hats.reshape(len(rows), -1)], axis=1)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Moments:
    """Means of x and x x' over the unlabelled rows (u) and the trusted positives (p), and how many there were."""

    n_u: float
    n_p: float
    mean_u: np.ndarray
    mean_p: np.ndarray
    square_u: np.ndarray
    square_p: np.ndarray


def moments(rows: DataFrame) -> Moments:
    """``rows``: features, positive (boolean).  Every row is unlabelled text; trusted positives count there too.

    Tasks emit one number for each pair of basis functions; what reaches the
    driver is as many numbers as the model has pairs, for any number of rows.
    """
    width = 1 + len(FEATURES) * KNOTS
    upper = np.triu_indices(width)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, width, width))
        for batch in batches:
            x = expand(_matrix(batch.column("features")))
            positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            sums[0] += x.T @ x
            sums[1] += x[positive].T @ x[positive]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]))), pa.array(sums[0][upper]), pa.array(sums[1][upper])], ["cell", "u", "p"]
        )

    cells = (
        rows.select("features", "positive").mapInArrow(run, "cell long, u double, p double")
        .groupBy("cell").agg(F.sum("u").alias("u"), F.sum("p").alias("p")).toPandas().sort_values("cell")
    )
    full = np.zeros((2, width, width))
    for k, name in enumerate("up"):
        full[k][upper] = cells[name] if len(cells) else 0.0
        full[k] += np.triu(full[k], 1).T
    n_u, n_p = full[0][0, 0], full[1][0, 0]
    square_u, square_p = full[0] / max(1.0, n_u), full[1] / max(1.0, n_p)
    return Moments(n_u, n_p, square_u[0], square_p[0], square_u, square_p)


def fit(m: Moments, prior: float, ridge: float = 0.01, steps: int = 300) -> np.ndarray:
    """Weights of least non-negative risk.

    The unbiased risk is quadratic and solved directly.  Where its negative
    part is below zero there, steps go on as in stochastic nnPU: against that
    part while it is negative, down the whole risk otherwise.
    """
    shrunk = np.r_[1e-6, np.full(len(m.mean_u) - 1, ridge)]  # not the constant
    left = m.square_u / 2 + 2 * np.diag(shrunk)

    def risks(w: np.ndarray) -> tuple[float, float]:
        p = (1 + w @ m.square_p @ w) / 4
        negative = (1 + 2 * m.mean_u @ w + w @ m.square_u @ w) / 4 - prior * (p + m.mean_p @ w / 2)
        return prior * (p - m.mean_p @ w / 2) + shrunk @ w**2, negative

    w = np.linalg.solve(left, prior * m.mean_p - m.mean_u / 2)
    rest, negative = risks(w)
    if negative >= 0:
        return w
    best, least = w, rest
    for _ in range(steps):
        slope_n = (m.mean_u + m.square_u @ w) / 2 - prior * (m.mean_p + m.square_p @ w) / 2
        slope_p = prior * (m.square_p @ w - m.mean_p) / 2
        w = w - 0.1 * np.linalg.solve(left, slope_p + slope_n + 2 * shrunk * w if negative >= 0 else -slope_n)
        rest, negative = risks(w)
        if (risk := rest + max(0.0, negative)) < least:
            best, least = w, risk
    return best


def _score(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip((x @ weights + 1) / 2, 0.0, 1.0)


def estimate_prior(rows: DataFrame, weights: np.ndarray) -> float:
    """Class prior: the least ratio of unlabelled to positive mass above any score that enough positives exceed.

    U = pi P + (1 - pi) N, so each region holds at least pi times the positives'
    share of it; regions of high scores hold little else.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS), np.int64)
        for batch in batches:
            at = np.minimum((_score(expand(_matrix(batch.column("features"))), weights) * BINS).astype(int), BINS - 1)
            positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            counts[0] += np.bincount(at, minlength=BINS)
            counts[1] += np.bincount(at[positive], minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), *map(pa.array, counts)], ["bin", "u", "p"])

    bins = (
        rows.select("features", "positive").mapInArrow(run, "bin long, u long, p long")
        .groupBy("bin").agg(F.sum("u").alias("u"), F.sum("p").alias("p")).toPandas().sort_values("bin")
    )
    above = np.stack([bins[c].to_numpy(float)[::-1].cumsum() for c in "up"])
    shares = above / np.maximum(1.0, above[:, -1:])
    enough = shares[1] >= PRIOR_SUPPORT
    if not enough.any():
        return 0.5
    # Half a standard error at most for either share, or the least of many ratios would be too low on few rows.
    slack = 0.5 / np.sqrt(np.maximum(1.0, above[:, -1]))
    ratios = (shares[0][enough] + slack[0]) / np.maximum(1e-9, shares[1][enough] - slack[1])
    return float(np.clip(ratios.min(), 0.05, 0.99))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    prior: float

    def score(self, features: Column) -> Column:
        weights = self.weights

        @F.arrow_udf("double")
        def run(rows: pa.Array) -> pa.Array:
            return pa.array(_score(expand(_matrix(rows)), weights))

        return run(features)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether no label of this row may be learned from; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def train(described: DataFrame, labels: DataFrame, start: float = 0.5) -> Model:
    """Fit on all rows of ``described`` (doc_id, features) and the trusted positives of ``labels`` (doc_id, quality).

    A document is a trusted positive if any label of its id is 1 and it is not
    held out.  Without a trusted positive the score is ``start`` everywhere.
    """
    trusted = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.lit(True).alias("positive")).distinct()
    )
    rows = land(
        described.join(trusted, "doc_id", "left").select("features", F.coalesce("positive", F.lit(False)).alias("positive")),
        "quality-rows",
    )
    m = moments(rows)
    if m.n_p == 0:
        return Model(np.r_[2 * start - 1, np.zeros(len(m.mean_u) - 1)], start)
    prior = estimate_prior(rows, fit(m, start))
    prior = estimate_prior(rows, fit(m, prior))
    return Model(fit(m, prior), prior)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text); labels as in ``train``.

    The score is the estimated probability of label 1, from the text alone.
    NULL, empty and blank texts share one score.  Repeated rows each get their
    row and weigh in each time.  Labels without a document, NULL labels and
    NULL ids in the labels are ignored; an empty table gives no rows.
    """
    described = land(docs.select("doc_id", features(F.col("text")).alias("features")), "quality-features")
    model = train(described, labels)
    score = model.score(F.col("features"))
    return described.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) whose score reaches the threshold, as they are.

    Fits on ``docs`` itself, as ``classify`` does; NULL, empty and blank texts
    share one score, repeated rows stay or go together, and columns of any name
    stay.  An empty table stays empty; without a trusted positive the score is
    0.5 everywhere.  Texts, long ones too, are read once, and whole.
    """
    name = spare_name(docs.columns, "features")
    described = land(docs.withColumn(name, features(F.col("text"))), "quality-features")
    model = train(described.select("doc_id", F.col(name).alias("features")), labels)
    return described.filter(model.score(F.col(name)) >= threshold).drop(name)
