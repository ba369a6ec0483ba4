"""Radial kernel features and calibrated pair classifiers: a kernel machine with probabilities.

``KernelMap`` replaces vectors by their Nyström features: kernel values with a bounded number of landmark
rows, whitened so that dot products of the features approximate the kernel (exactly so between landmarks).
A linear machine on them is a kernel machine whose size does not grow with the rows.

``CalibratedPairs`` fits one linear margin machine for each pair of labels. Margins of rows that a machine
has not seen, from folds, give each pair a sigmoid; the pair probabilities of a row are coupled to
probabilities of the labels by least squares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.labels import LABELS
from ..functions.vectors import argmax_label
from ..session import materialize
from .folds import with_folds
from .stages import _WithParts

LANDMARKS = 200
SMALL = 1e-10  # eigenvalues below this share of the largest carry nothing
NEWTON_STEPS = 30


def _vector_function(fn):
    """An Arrow function from an array column to an array column, by whole batches of rows."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n = len(batch)
            out = fn(batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)).tolist() if n else []
            yield pa.array(out, pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>", F.ArrowUDFType.SCALAR_ITER)


def radial(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(square, 0.0))


def scale_gamma(df: DataFrame, features: str = "features") -> float:
    """One over the number of entries times their variance."""
    entries = df.select(F.posexplode(vector_to_array(features)).alias("i", "v"))
    row = entries.agg(F.max("i"), F.var_pop("v")).first()
    return 1.0 if row[0] is None or not row[1] else 1.0 / ((row[0] + 1) * row[1])


class KernelMap(Estimator, _WithParts):
    """``features`` to ``kernel``; ``landmarks`` bounds the different rows (those of smallest hash) that are compared with."""

    def __init__(self, landmarks: int = LANDMARKS, gamma: float | None = None):
        super().__init__()
        self.landmarks, self.gamma = landmarks, gamma

    def settings(self) -> dict:
        return {"landmarks": self.landmarks, "gamma": self.gamma}

    def save_parts(self, folder: str) -> None:
        """Everything is in the settings."""

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> KernelMap:
        return cls(**settings)

    def _fit(self, df: DataFrame) -> KernelMapModel:
        gamma = scale_gamma(df) if self.gamma is None else self.gamma
        rows = df.select(vector_to_array("features").alias("x")).distinct()
        chosen = rows.orderBy(F.xxhash64("x"), "x").limit(self.landmarks).collect()
        points = np.array([r["x"] for r in chosen])
        values, vectors = np.linalg.eigh(radial(points, points, gamma))
        used = values > SMALL * values.max()
        return KernelMapModel(points, vectors[:, used] / np.sqrt(values[used]), gamma)


class KernelMapModel(Model, _WithParts):
    def __init__(self, points: np.ndarray, weights: np.ndarray, gamma: float):
        super().__init__()
        self.points, self.weights, self.gamma = points, weights, gamma

    def settings(self) -> dict:
        return {"gamma": self.gamma}

    def save_parts(self, folder: str) -> None:
        rows = [(k, p.tolist(), w.tolist()) for k, (p, w) in enumerate(zip(self.points, self.weights))]
        frame = SparkSession.active().createDataFrame(rows, "nr int, point array<double>, weights array<double>")
        frame.write.mode("overwrite").parquet(f"{folder}/landmarks")

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> KernelMapModel:
        rows = spark.read.parquet(f"{folder}/landmarks").orderBy("nr").collect()  # at most the landmarks
        return cls(np.array([r["point"] for r in rows]), np.array([r["weights"] for r in rows]), settings["gamma"])

    def _transform(self, df: DataFrame) -> DataFrame:
        points, weights, gamma = self.points, self.weights, self.gamma
        mapped = _vector_function(lambda x: radial(x, points, gamma) @ weights)
        return df.withColumn("kernel", array_to_vector(mapped(vector_to_array("features"))))


def couple(chances: np.ndarray) -> np.ndarray:
    """Probabilities p (rows x k) from pair chances r (rows x k x k): least squares of r_ji p_i - r_ij p_j."""
    n, k, _ = chances.shape
    system = np.zeros((n, k + 1, k + 1))
    system[:, :k, :k] = -chances * chances.transpose(0, 2, 1)
    square = (chances ** 2).sum(axis=1) - chances[:, range(k), range(k)] ** 2
    system[:, range(k), range(k)] = square
    system[:, :k, k] = system[:, k, :k] = 1.0
    target = np.zeros((n, k + 1, 1))
    target[:, k] = 1.0
    p = np.maximum(np.linalg.solve(system, target)[:, :k, 0], 0.0)
    return p / p.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Pair:
    """A machine that tells label ``a`` (positive margins) from ``b``, and its sigmoid 1 / (1 + exp(slope * m + shift))."""

    a: int
    b: int
    weights: list[float]
    bias: float
    slope: float
    shift: float


def fit_sigmoids(margins: DataFrame) -> dict[int, tuple[float, float]]:
    """Slope and shift for each ``pair`` of ``pair, margin, positive``, by Newton steps over sums of all rows.

    Targets are drawn in as is usual for this calibration: (n+ + 1) / (n+ + 2) and 1 / (n- + 2).
    """
    sizes = {r["pair"]: (r["pos"], r["all"] - r["pos"]) for r in margins.groupBy("pair").agg(
        F.sum(F.col("positive").cast("int")).alias("pos"), F.count("*").alias("all")).collect()}
    known = {p: (0.0, float(np.log((neg + 1) / (pos + 1)))) for p, (pos, neg) in sizes.items()}
    damping = dict.fromkeys(known, 1e-6)
    last: dict[int, float] = {}
    best = dict(known)

    def by_pair(values: dict[int, float]):
        return F.create_map(*[F.lit(x) for p, v in values.items() for x in (p, float(v))])[F.col("pair")]

    high = {p: (pos + 1) / (pos + 2) for p, (pos, _) in sizes.items()}
    low = {p: 1 / (neg + 2) for p, (_, neg) in sizes.items()}
    rows = margins.withColumn("t", F.when(F.col("positive"), by_pair(high)).otherwise(by_pair(low))) if known else margins
    for _ in range(NEWTON_STEPS if known else 0):
        z = by_pair({p: a for p, (a, _) in known.items()}) * F.col("margin") + by_pair({p: b for p, (_, b) in known.items()})
        p = 1 / (1 + F.exp(z))
        # -(t log p + (1 - t) log(1 - p)), without overflow
        loss = F.col("t") * z + F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        d, h, m = F.col("t") - p, p * (1 - p), F.col("margin")
        sums = rows.groupBy("pair").agg(*[F.sum(x).alias(n) for n, x in (
            ("loss", loss), ("ga", m * d), ("gb", d), ("haa", m * m * h), ("hab", m * h), ("hbb", h))]).collect()
        settled = True
        for r in sums:
            pair = r["pair"]
            if pair in last and r["loss"] > last[pair] + 1e-12:  # the step was too long
                known[pair] = tuple((np.array(known[pair]) + np.array(best[pair])) / 2)
                settled = settled and abs(known[pair][0] - best[pair][0]) < 1e-9
                continue
            settled = settled and pair in last and last[pair] - r["loss"] <= 1e-10 * (1 + abs(r["loss"]))
            last[pair], best[pair] = r["loss"], known[pair]
            hessian = np.array([[r["haa"], r["hab"]], [r["hab"], r["hbb"]]]) + damping[pair] * np.eye(2)
            step = np.linalg.solve(hessian, np.array([r["ga"], r["gb"]]))
            known[pair] = tuple(np.array(known[pair]) - step)
        if settled:
            break
    return best


class CalibratedPairs(Estimator, _WithParts):
    """Fits on ``id``, ``label``, a vector column and the zero-based ``target``."""

    def __init__(self, c: float = 1.0, folds: int = 3, max_iter: int = 100, features: str = "kernel", parallelism: int = 8):
        super().__init__()
        self.c, self.folds, self.max_iter, self.features, self.parallelism = c, folds, max_iter, features, parallelism

    def settings(self) -> dict:
        return {k: getattr(self, k) for k in ("c", "folds", "max_iter", "features", "parallelism")}

    def save_parts(self, folder: str) -> None:
        """Everything is in the settings."""

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> CalibratedPairs:
        return cls(**settings)

    def _fit(self, df: DataFrame) -> CalibratedPairsModel:
        rows = materialize(with_folds(df.select("id", "label", "target", F.col(self.features).alias("features")), self.folds), "pairs")
        sizes = {int(r["target"]): r["n"] for r in rows.groupBy("target").agg(F.count("*").alias("n")).collect()}
        pairs = list(combinations(sorted(sizes), 2))

        def machine(job: tuple[int, int | None]):
            a, b = pairs[job[0]]
            two = rows.where(F.col("target").isin(a, b)).withColumn("label", (F.col("target") == a).cast("double"))
            seen = two if job[1] is None else two.where(F.col("fold") != job[1])
            n = (sizes[a] + sizes[b]) * (1.0 if job[1] is None else 1 - 1 / self.folds)
            if job[1] is not None and seen.select("label").distinct().count() < 2:
                return None  # a fold holds all rows of a label
            model = LinearSVC(regParam=1.0 / (self.c * n), maxIter=self.max_iter, standardization=False).fit(seen)
            if job[1] is None:
                return model
            margins = model.transform(two.where(F.col("fold") == job[1]))
            return margins.select(F.lit(job[0]).alias("pair"), vector_to_array("rawPrediction")[1].alias("margin"),
                                  (F.col("label") == 1).alias("positive"))

        jobs = [(p, f) for p in range(len(pairs)) for f in (None, *range(self.folds))]
        with ThreadPool(self.parallelism) as pool:
            done = dict(zip(jobs, pool.map(inheritable_thread_target(df.sparkSession)(machine), jobs)))
        unseen = [m for (_, f), m in done.items() if f is not None and m is not None]
        sigmoids = {}
        if unseen:
            stacked = unseen[0]
            for more in unseen[1:]:
                stacked = stacked.unionByName(more)
            sigmoids = fit_sigmoids(materialize(stacked, "margins"))
        found = []
        for p, (a, b) in enumerate(pairs):
            model = done[p, None]
            slope, shift = sigmoids.get(p, (-1.0, 0.0))
            found.append(Pair(a, b, model.coefficients.toArray().tolist(), model.intercept, slope, shift))
        return CalibratedPairsModel(found, sorted(sizes), self.features)


class CalibratedPairsModel(Model, _WithParts):
    """Adds ``probability`` over all labels (0 for labels never seen) and the likeliest as ``prediction``."""

    def __init__(self, pairs: list[Pair], seen: list[int], features: str):
        super().__init__()
        self.pairs, self.seen, self.features = pairs, seen, features

    def settings(self) -> dict:
        return {"pairs": [vars(p) for p in self.pairs], "seen": self.seen, "features": self.features}

    def save_parts(self, folder: str) -> None:
        """Everything is in the settings."""

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> CalibratedPairsModel:
        return cls([Pair(**p) for p in settings["pairs"]], settings["seen"], settings["features"])

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs, place, size = self.pairs, {x: i for i, x in enumerate(self.seen)}, len(LABELS)
        weights = np.array([p.weights for p in pairs]).T
        bias, slope, shift = (np.array([getattr(p, x) for p in pairs]) for x in ("bias", "slope", "shift"))

        def score(x: np.ndarray) -> np.ndarray:
            out = np.zeros((len(x), size))
            if len(place) == 1:
                out[:, list(place)] = 1.0
                return out
            chance = 1 / (1 + np.exp(np.clip(slope * (x @ weights + bias) + shift, -30, 30)))
            r = np.zeros((len(x), len(place), len(place)))
            for k, p in enumerate(pairs):
                r[:, place[p.a], place[p.b]] = np.clip(chance[:, k], 1e-7, 1 - 1e-7)
                r[:, place[p.b], place[p.a]] = 1 - r[:, place[p.a], place[p.b]]
            out[:, list(place)] = couple(r)
            return out

        scored = _vector_function(score)
        out = df.withColumn("_shares", scored(vector_to_array(self.features)))
        return out.withColumns({"probability": array_to_vector("_shares"),
                                "prediction": argmax_label("_shares").cast("double")}).drop("_shares")


def kernel_svm(c: float = 1.0, landmarks: int = LANDMARKS, gamma: float | None = None, folds: int = 3) -> Pipeline:
    """Radial kernel machine with probabilities."""
    return Pipeline(stages=[KernelMap(landmarks, gamma), CalibratedPairs(c, folds)])
