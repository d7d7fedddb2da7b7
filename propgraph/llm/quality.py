"""Quality by positive-unlabelled learning with the non-negative risk estimator.

After Kiryo et al., "Positive-Unlabeled Learning with Non-Negative Risk Estimator" (2017).
A logistic model over plain statistics of the text is trained on trusted positives and on
unlabelled documents. With the class prior p, the risk of negatives is that of the
unlabelled less p times that of the positives; where the estimate falls below zero the
model has begun to fit the sample, and the step goes the other way.

The class prior is the share of positives among all training labels; no negative label is
used otherwise. With the logistic loss the estimate is convex, so a few Newton steps find
its minimum; where the risk of negatives would fall below zero, steps go along its zero
line instead. Each step is one pass of Spark over the features of every trusted positive
and every document without a label; a task sends the sums of loss, gradient and curvature.

Defined results: a null text counts as empty; all of its statistics are 0. Every row is
scored by itself, repeated rows alike, and every row of a trusted id is a positive. A
document is unlabelled if ``labels`` has no row of its id, and so is one with a null id.
Without trusted positives, or without documents outside the labels, every score is the prior.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from propgraph.llm.common import whole_text
from propgraph.llm.training import held_out
from propgraph.operators.joins import hub_join
from propgraph.staging import stage

STEPS = 30
HALVINGS = 8
CLOSE = 1e-5  # a step that lowers the risk by less is the last
BELOW = 10.0  # what a risk of negatives below zero adds to the risk, for each unit
DECAY = 1e-3
BLOCK = 1 << 16  # bytes given to the compressor at once

# classes of bytes: 0 other, 1 small letter, 2 capital, 3 digit, 4 space, 5 line end, 6 sentence mark,
# 7 exclamation or question mark, 8 bar, 9 further mark, 10 beyond ASCII
_CLASS = np.zeros(256, np.uint8)
for _n, _chars in enumerate(("", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", "\n", ".,;:'\"()-", "!?", "|", "#$%&*+/<=>@[\\]^_`{}~")):
    _CLASS[list(_chars.encode())] = _n
_CLASS[128:] = 10
NAMES = (
    *(f"share_{n}" for n in ("other", "small", "capital", "digit", "space", "line", "mark", "shout", "bar", "symbol", "high")),
    "log_bytes", "log_words", "word_length", "new_words", "log_lines", "new_lines", "line_words", "capital_words",
    "packed", "letters_in_words",
)


def packed_size(data: bytes) -> int:
    """Size of the whole of ``data`` when compressed; the packed bytes are counted block by block and not kept."""
    packer, view = zlib.compressobj(1), memoryview(data)
    return sum(len(packer.compress(view[i : i + BLOCK])) for i in range(0, len(data), BLOCK)) + len(packer.flush())


def features(text: str) -> np.ndarray:
    """Plain statistics of a whole text, in the order of NAMES."""
    out = np.zeros(len(NAMES))
    data = text.encode()
    if not data:
        return out
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=11)
    words, lines = data.split(), data.split(b"\n")
    n = max(1, len(words))
    letters = kinds[1] + kinds[2] + kinds[10]
    out[:11] = kinds / len(data)
    out[11:] = (
        np.log(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        np.log(len(lines)),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        kinds[2] / max(1, letters),
        packed_size(data) / len(data),
        letters / max(1, len(data) - kinds[4] - kinds[5]),
    )
    return out


@dataclass
class Scale:
    """Mean and spread of the features over all documents."""

    mean: np.ndarray
    spread: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Standardised features and a column of ones."""
        return np.column_stack([np.clip((x - self.mean) / self.spread, -8, 8), np.ones(len(x))])


@dataclass
class Model:
    scale: Scale
    theta: np.ndarray  # a weight per feature, then the bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.scale(x) @ self.theta)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Sums:
    """What the rows add up to at one ``theta``, positive (0) and unlabelled (1) rows apart."""

    n: np.ndarray
    loss: np.ndarray  # of the rows taken as negative: log(1 + e^z)
    x: np.ndarray
    slope: np.ndarray  # of the loss
    curve: np.ndarray
    theta: np.ndarray

    @staticmethod
    def of(positive: np.ndarray, unlabelled: np.ndarray, theta: np.ndarray) -> Sums:
        """Sums over scaled rows."""
        n, loss, x, slope, curve = [], [], [], [], []
        for rows in (positive, unlabelled):
            z = rows @ theta
            g = _logistic(z)
            n.append(len(rows))
            loss.append(np.logaddexp(0, z).sum())
            x.append(rows.sum(0))
            slope.append(g @ rows)
            curve.append((rows * (g * (1 - g))[:, None]).T @ rows)
        return Sums(*(np.array(v, float) for v in (n, loss, x, slope, curve)), theta)

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in (self.n, self.loss, self.x, self.slope, self.curve)])

    @staticmethod
    def from_flat(values: np.ndarray, theta: np.ndarray) -> Sums:
        k = len(theta)
        n, loss, x, slope, curve = np.split(values, np.cumsum([2, 2, 2 * k, 2 * k]))
        return Sums(n, loss, x.reshape(2, k), slope.reshape(2, k), curve.reshape(2, k, k), theta)

    @staticmethod
    def size(k: int) -> int:
        return 4 + 4 * k + 2 * k * k

    def negative_risk(self, prior: float) -> float:
        return self.loss[1] / self.n[1] - prior * self.loss[0] / self.n[0]

    def risk(self, prior: float) -> float:
        """As positive a row loses log(1 + e^-z), which is its loss as negative less z."""
        plain = self.loss[1] / self.n[1] - prior * (self.x[0] @ self.theta) / self.n[0]
        return plain + DECAY / 2 * self.theta @ self.theta + BELOW * max(0.0, -self.negative_risk(prior))

    def newton(self, prior: float, held: float) -> tuple[np.ndarray, float, float]:
        """The step to add to theta, about twice the risk that it saves, and what holds the risk of negatives at zero.

        The step is the least of the quadratic model at which the risk of negatives, to
        first order, is not below zero. ``held`` is the last step's multiplier of that bound.
        """
        (n_p, n_u), k = self.n, len(self.theta)
        gradient = self.slope[1] / n_u - prior * self.x[0] / n_p + DECAY * self.theta
        bound = self.slope[1] / n_u - prior * self.slope[0] / n_p
        held = min(held, 0.95)
        curve = (1 - held) * self.curve[1] / n_u + held * prior * self.curve[0] / n_p + DECAY * np.eye(k)
        free, turn = np.linalg.solve(curve, np.column_stack([-gradient, bound])).T
        short = -(self.negative_risk(prior) + bound @ free)
        held = min(BELOW, max(0.0, short / max(bound @ turn, 1e-12)))
        step = free + held * turn
        return step, float(step @ curve @ step), held


def minimise(sums: Callable[[np.ndarray], Sums], prior: float, k: int) -> np.ndarray:
    """The theta of least risk that Newton's steps reach."""
    theta = np.zeros(k)
    theta[-1] = np.log(prior / (1 - prior))
    here, held = sums(theta), 0.0
    if not here.n.all():
        return theta
    for _ in range(STEPS):
        step, saved, held = here.newton(prior, held)
        if saved < CLOSE:
            break
        for halving in range(HALVINGS):
            there = sums(here.theta + step * 0.5**halving)
            if there.risk(prior) < here.risk(prior):
                break
        else:
            break
        here = there
    return here.theta


@F.arrow_udf(ArrayType(DoubleType()))
def feature_column(texts: pa.Array) -> pa.Array:
    return pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))  # a text at a time


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def _added(rows: DataFrame, add: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum of ``add`` over all batches: each task sends ``size`` numbers, the driver gets as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += add(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["place", "value"])

    found = rows.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for place, value in found:
        out[place] = value
    return out


def _scale(vectors: DataFrame) -> Scale:
    def add(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch.column("x"))
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    k = len(NAMES)
    sums = _added(vectors.select("x"), add, 1 + 2 * k)
    n = max(1.0, sums[0])
    mean = sums[1 : 1 + k] / n
    return Scale(mean, np.sqrt(np.maximum(sums[1 + k :] / n - mean**2, 0)) + 1e-6)


def _sums(rows: DataFrame, scale: Scale, theta: np.ndarray) -> Sums:
    """``rows``: positive, x."""

    def add(batch: pa.RecordBatch) -> np.ndarray:
        x, good = scale(_matrix(batch.column("x"))), batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        return Sums.of(x[good], x[~good], theta).flat()

    return Sums.from_flat(_added(rows, add, Sums.size(len(theta))), theta)


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and the features x of each row, written once. ``docs``: doc_id, text (not null)."""
    return stage(docs.select("doc_id", feature_column("text").alias("x")), "quality-features")


def training_rows(found: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Every trusted positive and every document that ``labels`` does not know: positive, x. Held-out rows are neither."""
    trusted = F.coalesce((F.col(label) == 1) & ~held_out(F.col("doc_id")), F.lit(False))
    known = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), trusted.alias("positive"))
    known = known.groupBy("doc_id").agg(F.max("positive").alias("positive"))
    both = hub_join(found, known, ["doc_id"], "left")
    return both.where("positive IS NULL OR positive").select(F.coalesce("positive", F.lit(False)).alias("positive"), "x")


def class_prior(labels: DataFrame, label: str) -> float:
    """The smoothed share of positives among the ids with a training label."""
    rows = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", label).distinct()
    n = dict(rows.groupBy(label).count().collect())
    return min(0.99, max(0.01, (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)))


def fit(found: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """``found``: the rows of ``vectors``."""
    scale, prior = _scale(found), class_prior(labels, label)
    rows = stage(training_rows(found, labels, label), "quality-rows")
    return Model(scale, minimise(lambda theta: _sums(rows, scale, theta), prior, len(NAMES) + 1))


def scored(model: Model, x: Column) -> Column:
    @F.arrow_udf(DoubleType())
    def score(rows: pa.Array) -> pa.Array:
        return pa.array(model.scores(_matrix(rows)), pa.float64())

    return score(x)


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    found = vectors(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")))
    rows = found.select("doc_id", scored(fit(found, labels, label), F.col("x")).alias("score"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )
