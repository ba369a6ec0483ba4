"""Ordinal regression with two heads on one representation, under one weighted loss.

A layer of ``hidden`` units feeds four cumulative heads (is the label above k?) and one head over the five
labels. The loss of a row is ``alpha`` times the mean cross entropy of the cumulative heads plus ``beta``
times the cross entropy of the labels. All weights are fitted together by limited-memory quasi-Newton
steps: for each step the tasks sum loss and gradient over their rows, and one aggregation adds the sums up,
entry by entry. The number of weights does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import vectors as V
from ..functions.labels import LABELS
from ..session import materialize
from .evaluate import balanced_weight

K = len(LABELS)
MEMORY = 10


@dataclass(frozen=True)
class Shape:
    width: int
    hidden: int
    alpha: float = 0.7
    beta: float = 0.3

    def parts(self, w: np.ndarray) -> list[np.ndarray]:
        """Layer, its shift, cumulative heads and their shifts, label head and its shifts."""
        shapes = [(self.width, self.hidden), (self.hidden,), (self.hidden, K - 1), (K - 1,), (self.hidden, K), (K,)]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return [x.reshape(s) for x, s in zip(np.split(w, ends[:-1]), shapes)]

    @property
    def size(self) -> int:
        return (self.width + 1) * self.hidden + (self.hidden + 1) * (2 * K - 1)


def outputs(w: np.ndarray, x: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    layer, shift, heads, head_shift, labels, label_shift = shape.parts(w)
    z = np.tanh(x @ layer + shift)
    return z, z @ heads + head_shift, z @ labels + label_shift


def loss_and_gradient(w: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray, shape: Shape) -> tuple[float, np.ndarray]:
    """Sums over the rows; ``y`` counts from 0."""
    _, _, heads, _, labels, _ = shape.parts(w)
    z, above, scores = outputs(w, x, shape)
    truth = (y[:, None] > np.arange(K - 1)).astype(float)
    ordinal = (np.maximum(above, 0) - above * truth + np.log1p(np.exp(-np.abs(above)))).mean(axis=1)
    top = scores.max(axis=1, keepdims=True)
    total = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
    classes = total - scores[np.arange(len(y)), y]
    loss = float((weight * (shape.alpha * ordinal + shape.beta * classes)).sum())
    d_above = weight[:, None] * shape.alpha / (K - 1) * (1 / (1 + np.exp(-np.clip(above, -500, 500))) - truth)
    d_scores = np.exp(scores - total[:, None])
    d_scores[np.arange(len(y)), y] -= 1
    d_scores *= weight[:, None] * shape.beta
    d_z = (d_above @ heads.T + d_scores @ labels.T) * (1 - z * z)
    parts = (x.T @ d_z, d_z.sum(axis=0), z.T @ d_above, d_above.sum(axis=0), z.T @ d_scores, d_scores.sum(axis=0))
    return loss, np.concatenate([p.ravel() for p in parts])


def quasi_newton(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int, tolerance: float) -> tuple[np.ndarray, list[float]]:
    """Limited-memory BFGS with step halving; the weights and the loss after each step."""
    w, (loss, gradient) = start, value(start)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    losses = [loss]
    for _ in range(steps):
        direction, used = gradient.copy(), []
        for s, y in reversed(history):
            a = s @ direction / (y @ s)
            direction -= a * y
            used.append(a)
        if history:
            s, y = history[-1]
            direction *= s @ y / (y @ y)
        for (s, y), a in zip(history, reversed(used)):
            direction += s * (a - y @ direction / (y @ s))
        rate, slope = 1.0 if history else min(1.0, 1 / np.abs(gradient).sum()), gradient @ direction
        while True:
            after = w - rate * direction
            new_loss, new_gradient = value(after)
            if new_loss <= loss - 1e-4 * rate * slope or rate < 1e-8:
                break
            rate /= 2
        if new_loss > loss:
            break
        if (new_gradient - gradient) @ (after - w) > 1e-12:
            history = [*history, (after - w, new_gradient - gradient)][-MEMORY:]
        change = loss - new_loss
        w, loss, gradient = after, new_loss, new_gradient
        losses.append(loss)
        if change <= tolerance * max(1.0, abs(loss)):
            break
    return w, losses


@dataclass(frozen=True)
class JointModel:
    weights: np.ndarray
    shape: Shape
    mean: np.ndarray
    deviation: np.ndarray
    gamma: float
    losses: tuple[float, ...] = ()

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``score``, the blend of the expected labels of both heads."""
        w, shape, mean, deviation = self.weights, self.shape, self.mean, self.deviation

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                n = len(batch)
                x = batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, shape.width))
                _, above, scores = outputs(w, (x - mean) / deviation, shape)
                yield pa.array(np.hstack([above, scores]).tolist(), pa.list_(pa.float64()))

        scored = F.arrow_udf(run, "array<double>", F.ArrowUDFType.SCALAR_ITER)
        out = df.withColumn("_heads", scored(vector_to_array("features")))
        blend = V.ev_blend(V.ev_ordinal(F.slice("_heads", 1, K - 1)), V.ev_softmax(F.slice("_heads", K, K)), self.gamma)
        return out.withColumn("score", blend).drop("_heads")

    def save(self, folder: str) -> None:
        """One row: the weights and what they go with."""
        row = (self.weights.tolist(), self.shape.width, self.shape.hidden, self.shape.alpha, self.shape.beta,
               self.mean.tolist(), self.deviation.tolist(), self.gamma)
        ddl = ("weights array<double>, width int, hidden int, alpha double, beta double, mean array<double>, "
               "deviation array<double>, gamma double")
        SparkSession.active().createDataFrame([row], ddl).write.mode("overwrite").parquet(folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> JointModel:
        r = spark.read.parquet(folder).first()
        return cls(np.array(r["weights"]), Shape(r["width"], r["hidden"], r["alpha"], r["beta"]),
                   np.array(r["mean"]), np.array(r["deviation"]), r["gamma"])


SUMS = pa.schema([("sums", pa.list_(pa.float64()))])


def joint_ordinal(df: DataFrame, *, hidden: int = 16, alpha: float = 0.7, beta: float = 0.3, gamma: float = 0.6,
                  penalty: float = 1e-3, steps: int = 60, tolerance: float = 1e-5, seed: int = 42) -> JointModel:
    """Fit on ``features`` and ``label`` with class-balanced weights; ``penalty`` is per row."""
    rows = balanced_weight(df, "label").select(
        vector_to_array("features").alias("x"), (F.col("label") - 1).cast("int").alias("y"), F.col("weight").cast("double").alias("weight"))
    rows = materialize(rows, "joint")
    n = rows.count()
    if not n:
        raise ValueError("no rows to fit")
    entries = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
    stats = entries.orderBy("i").collect()  # one row for each entry of the vectors
    mean, deviation = np.array([r["m"] for r in stats]), np.array([r["s"] or 1.0 for r in stats])
    shape = Shape(len(stats), hidden, alpha, beta)

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape.size + 1)
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    y, weight = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                    loss, gradient = loss_and_gradient(w, (x - mean) / deviation, y, weight, shape)
                    total += np.concatenate([[loss], gradient])
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], SUMS.field(0).type)], schema=SUMS)

        sums = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
        found = sums.groupBy("i").agg(F.sum("v").alias("v")).collect()  # one row for each weight
        total = np.zeros(shape.size + 1)
        for r in found:
            total[r["i"]] = r["v"]
        return total[0] / n + penalty / 2 * float(w @ w), total[1:] / n + penalty * w

    start = np.random.default_rng(seed).normal(size=shape.size) / np.sqrt(shape.width)
    w, losses = quasi_newton(value, start, steps, tolerance)
    return JointModel(w, shape, mean, deviation, gamma, tuple(losses))
