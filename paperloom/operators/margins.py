"""Many linear margin classifiers fitted side by side, with the loss, scaling and steps of Spark's ``LinearSVC``.

A grid of sizes and penalties has hundreds of small fits, and a fit of its own takes a job for each of its
steps. Here each fit is a generator that names the next weights it wants the loss of. One job finds loss and
gradient for all fits that are still going, by a matrix product for each block of rows, so the jobs are as
many as the steps of the longest fit. The sums have a fixed size, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from ..functions.labels import LABELS

K = len(LABELS)
MEMORY = 10
TOLERANCE = 1e-6
SEARCHES = 20
BLOCK = 4096
PART = 50_000  # rows in a task: fewer would cost more to start than to add up

Asked = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class SearchFailed(Exception):
    """No step along the direction, or a history that bends the wrong way."""


def _direction(gradient: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Downhill by limited-memory BFGS, newest pair first; entries that turn against the gradient are 0."""
    out, used, scale = gradient.copy(), [], 1.0
    if history:
        s, y = history[0]
        sy = s @ y
        if not sy >= 0:
            raise SearchFailed
        with np.errstate(all="ignore"):
            scale = sy / (y @ y)
    with np.errstate(all="ignore"):
        for s, y in history:
            a = (s @ out) / (s @ y)
            if np.isnan(a):
                raise SearchFailed
            out -= a * y
            used.append(a)
        out *= scale
        for (s, y), a in zip(reversed(history), reversed(used)):
            out += (a - (y @ out) / (s @ y)) * s
        return np.where(-out * gradient < 0, -out, 0.0)


def _search(x: np.ndarray, value: float, gradient: np.ndarray, direction: np.ndarray, first: bool) -> Generator:
    """Halve or grow the step until the loss falls and the slope flattens; the new weights, loss and gradient."""
    slope = direction @ gradient
    orthant = np.where(x != 0, np.sign(x), np.sign(-gradient))

    def moved(step: float) -> np.ndarray:
        after = x + step * direction
        return np.where(np.sign(after) == orthant, after, 0.0)

    step, shrink = (0.5 / np.linalg.norm(gradient), 0.1) if first else (1.0, 0.5)
    after = found = None
    for n in range(SEARCHES):
        # The first step is judged by the loss before it, so it is nearly always cut without a look at the rows.
        if n or not value > value + step * slope * 1e-4:
            after = moved(step)
            found = yield after
        if (found[0] if n else value) > value + step * slope * 1e-4:
            factor = shrink
        elif found[1] @ direction < 0.9 * slope:
            factor = 2.1
        elif found[1] @ direction > -0.9 * slope:
            factor = shrink
        else:
            break
        step *= factor
        if not 1e-10 <= step <= 1e10:
            raise SearchFailed
    return after, *found


def quasi_newton(width: int, steps: int, tolerance: float = TOLERANCE) -> Asked:
    """Yields weights, is sent their loss and gradient, and returns the last weights.

    As Breeze's ``OWLQN`` does without a penalty on absolute values, which is what ``LinearSVC`` runs.
    """
    x = np.zeros(width)
    value, gradient = yield x
    first_value, seen, history, failed = value, [np.inf], [], False
    step = 0
    while True:
        done = step >= steps or (len(seen) >= 2 and abs(value - max(seen)) <= tolerance * first_value)
        if done or np.linalg.norm(gradient) <= max(tolerance * abs(value), 1e-8):
            return x
        try:
            direction = _direction(gradient, history)
            after, new_value, new_gradient = yield from _search(x, value, gradient, direction, step < 1)
        except SearchFailed:
            if failed:
                return x
            failed, history = True, []
            continue
        history = [(after - x, new_gradient - gradient), *history][:MEMORY]
        x, value, gradient, failed = after, new_value, new_gradient, False
        seen = [*seen, value][-20:]
        step += 1


@dataclass(frozen=True)
class Point:
    """One one-against-the-rest classifier: its group of rows, the first ``size`` entries, and the penalty."""

    group: int
    size: int
    penalty: float


def _blocks(groups: Mapping[int, DataFrame], stats: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> RDD:
    """``group, x, target, weight`` as arrays, entries centred and scaled, kept for all steps."""

    def stack(group: int):
        mean, inverse = stats[group]

        def run(rows: Iterator) -> Iterator[tuple]:
            held = []
            for r in rows:
                held.append(r)
                if len(held) == BLOCK:
                    yield block(held)
                    held = []
            if held:
                yield block(held)

        def block(held: list) -> tuple:
            x = np.array([r[0] for r in held]) * inverse - mean * inverse
            return group, x, np.array([r[1] for r in held]), np.array([r[2] for r in held])

        return run

    parts = []
    for group, df in groups.items():
        wanted = max(1, -(-df.count() // PART))
        rows = df.select(vector_to_array("pca").alias("x"), F.col("target").cast("int").alias("y"), F.col("weight").cast("double").alias("w"))
        parts.append(rows.coalesce(wanted).rdd.mapPartitions(stack(group)))
    return parts[0].context.union(parts).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(blocks: RDD, asked: Mapping[tuple[int, int], np.ndarray], points: Sequence[Point], width: int) -> np.ndarray:
    """By fit in the order of ``asked``: gradient by entry, of the shift, loss and weight, summed over the rows."""
    keys = list(asked)
    weights = np.zeros((len(keys), width + 1))
    for i, key in enumerate(keys):
        weights[i, :len(asked[key]) - 1], weights[i, -1] = asked[key][:-1], asked[key][-1]
    of_group = {g: np.array([i for i, (p, _) in enumerate(keys) if points[p].group == g], int) for g in {q.group for q in points}}
    label = np.array([k for _, k in keys])

    def run(parts: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((len(keys), width + 3))
        for group, x, target, weight in parts:
            at = of_group[group]
            if not len(at):
                continue
            sign = np.where(target[:, None] == label[at], 1.0, -1.0)
            loss = 1 - sign * (x @ weights[at, :-1].T + weights[at, -1])
            inside = (loss > 0) * weight[:, None]
            pull = -sign * inside
            total[at, :width] += pull.T @ x
            total[at, width] += pull.sum(axis=0)
            total[at, width + 1] += (loss * inside).sum(axis=0)
            total[at, width + 2] += weight.sum()
        yield total

    return blocks.mapPartitions(run).treeReduce(np.add)


def fit_side_by_side(groups: Mapping[int, DataFrame], points: Sequence[Point], max_iter: int = 200) -> list[np.ndarray]:
    """By point, the weights of all labels: a matrix of entries and, last, the shift, for vectors as they are.

    ``groups`` have columns ``pca`` (vector), ``target`` (from 0) and ``weight``.
    """
    stats, classes = {}, {}
    for g, df in groups.items():
        r = df.agg(Summarizer.metrics("mean", "std").summary(F.col("pca"), F.col("weight")).alias("s"), F.max("target").alias("top")).first()
        mean, deviation = r["s"]["mean"].toArray(), r["s"]["std"].toArray()
        stats[g] = mean, np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation != 0)
        classes[g] = int(r["top"]) + 1
    width = len(mean)
    blocks = _blocks(groups, stats)
    fits = {(i, k): quasi_newton(p.size + 1, max_iter) for i, p in enumerate(points) for k in range(classes[p.group])}
    asked, found = {key: next(fit) for key, fit in fits.items()}, {}
    try:
        while asked:
            answers = _sums(blocks, asked, points, width)
            following = {}
            for (key, w), total in zip(asked.items(), answers):
                point = points[key[0]]
                # The penalty holds for the vectors as they are, so entries are weighed by the square of their scale.
                ridge = point.penalty * stats[point.group][1][:point.size] ** 2 * w[:-1]
                gradient = np.append(total[:point.size], total[width]) / total[width + 2]
                gradient[:-1] += ridge
                try:
                    following[key] = fits[key].send((total[width + 1] / total[width + 2] + 0.5 * float(ridge @ w[:-1]), gradient))
                except StopIteration as end:
                    found[key] = end.value
            asked = following
    finally:
        blocks.unpersist()
    out = []
    for i, p in enumerate(points):
        mean, inverse = (a[:p.size] for a in stats[p.group])
        plain = np.zeros((classes[p.group], width + 1))
        for k in range(classes[p.group]):
            w = found[i, k]
            plain[k, :p.size], plain[k, -1] = w[:-1] * inverse, w[-1] - w[:-1] @ (inverse * mean)
        out.append(plain)
    return out


def predictions(df: DataFrame, weights: Sequence[np.ndarray]) -> DataFrame:
    """``label, point, prediction``: for each row the label from 1 of the largest margin, by each of ``weights``."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n = len(batch)
            if not n:
                yield pa.array([], pa.list_(pa.int32()))
                continue
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            best = np.stack([(x @ w[:, :-1].T + w[:, -1]).argmax(axis=1) + 1 for w in weights], axis=1)
            yield pa.array(best.tolist(), pa.list_(pa.int32()))

    said = F.arrow_udf(run, "array<int>", F.ArrowUDFType.SCALAR_ITER)
    return df.select("label", F.posexplode(said(vector_to_array("pca"))).alias("point", "prediction"))
