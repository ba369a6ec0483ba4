"""The best cut points for certain, by branch and bound over cumulative counts.

A box holds a range for each of the four cuts. Its objective is bounded from above: every score bin
gets, of the labels that the ranges allow it, the one with the least squared error and, apart from that,
the one with the largest chance agreement; a label's F1 gets all rows of its own that could fall to it and
only those of others that must. Boxes whose bound is below the best set known are dropped, the
others are halved. The counts have a fixed size, so the work does not depend on the rows; the first
boxes are spread over tasks, and each task starts from the best set of the coarse search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.labels import LABELS
from . import thresholds
from .thresholds import HIGH, LOW, NAMES, STEP

K = len(LABELS)
TIE = 5e-10  # objectives are compared to nine digits
BATCH = 8192
CELLS = 10  # ranges of a cut that the first boxes are made of


class Bounds:
    """Sums over score bins, as running totals at the places where a cut may stand."""

    def __init__(self, below: np.ndarray, step: int, f1_weight: float):
        places = np.concatenate([[0], np.arange(LOW, HIGH + 1, step) - (LOW - 1), [below.shape[1] - 1]])
        self.count = below[:, places].astype(float)  # by label, rows before each place
        self.last, self.f1_weight = len(places) - 1, f1_weight
        values = np.array(LABELS, float)
        self.truth = self.count[:, -1]
        self.n, y, yy = (float(self.truth @ values ** p) for p in (0, 1, 2))
        self.start = self.n * yy
        inside = np.diff(self.count, axis=1)
        gap = np.array([((values - v) ** 2) @ inside for v in values])
        chance = np.array([inside.sum(axis=0) * (self.n * v * v - 2 * y * v) for v in values])
        running = lambda x: np.concatenate([[0.0], np.cumsum(x)])
        self.gap = np.array([[running(gap[a:b + 1].min(axis=0)) if a <= b else np.zeros(self.last + 1) for b in range(K)] for a in range(K)])
        self.chance = np.array([[running(chance[a:b + 1].max(axis=0)) if a <= b else np.zeros(self.last + 1) for b in range(K)] for a in range(K)])

    def upper(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For boxes (rows of four places each), no set inside has a higher objective. Exact for a single set."""
        m = len(low)
        edges = np.sort(np.concatenate([low, high], axis=1), axis=1)
        edges = np.concatenate([np.zeros((m, 1), int), edges, np.full((m, 1), self.last)], axis=1)
        gap, chance = np.zeros(m), np.full(m, self.start)
        for a, b in zip(edges.T, edges.T[1:]):
            least, most = (high <= a[:, None]).sum(axis=1), (low <= a[:, None]).sum(axis=1)
            gap += self.gap[least, most, b] - self.gap[least, most, a]
            chance += self.chance[least, most, b] - self.chance[least, most, a]
        kappa = np.where(chance > 0, 1 - self.n * gap / np.maximum(chance, 1e-300), 0.0)
        single = (low == high).all(axis=1)
        kappa = np.where(single, kappa, np.maximum(kappa, 0.0))  # a set without chance agreement counts 0
        first, end = np.zeros((m, 1), int), np.full((m, 1), self.last)
        low_, high_ = np.hstack([first, low, end]), np.hstack([first, high, end])
        f1, present = np.zeros(m), np.zeros(m)
        for j in range(K):
            own = self.count[j][high_[:, j + 1]] - self.count[j][low_[:, j]]
            inner = np.maximum(self.count[:, low_[:, j + 1]] - self.count[:, high_[:, j]], 0.0)
            others = inner.sum(axis=0) - inner[j]
            size = self.truth[j] + own + others
            f1 += np.where(size > 0, 2 * own / np.maximum(size, 1e-300), 0.0)
            present += (self.truth[j] > 0) | (inner.sum(axis=0) > 0)
        mean = np.where(present > 0, f1 / np.maximum(present, 1), 0.0)
        return (1 - self.f1_weight) * kappa + self.f1_weight * mean

    def tightened(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Only increasing sets; boxes without one go."""
        low, high = low.copy(), high.copy()
        for k in range(1, 4):
            low[:, k] = np.maximum(low[:, k], low[:, k - 1] + 1)
        for k in (2, 1, 0):
            high[:, k] = np.minimum(high[:, k], high[:, k + 1] - 1)
        good = (low <= high).all(axis=1)
        return low[good], high[good]

    def search(self, low: np.ndarray, high: np.ndarray, best: float, cuts: tuple[int, ...]) -> tuple[float, tuple[int, ...]]:
        """The best set of the boxes, or the given one; of equal ones the lowest."""
        low, high = self.tightened(low, high)
        bound = self.upper(low, high)
        while len(low):
            hopeful = bound > best + TIE
            lower = np.zeros(len(low), bool)  # an equal set of lower cuts may be inside
            undecided = ~hopeful & (bound >= best - TIE)
            for k in range(4):
                lower |= undecided & (low[:, k] < cuts[k])
                undecided &= low[:, k] == cuts[k]
            keep = hopeful | lower
            low, high, bound = low[keep], high[keep], bound[keep]
            order = np.lexsort([*low.T[::-1], -np.round(bound, 9)])
            now, rest = order[:BATCH], order[BATCH:]
            some_low, some_high = low[now], high[now]
            single = (some_low == some_high).all(axis=1)
            for place in np.flatnonzero(single):
                value, found = bound[now][place], tuple(some_low[place].tolist())
                if value > best + TIE:
                    best, cuts = value, found
                elif value >= best - TIE and found < cuts:
                    best, cuts = max(value, best), found
            some_low, some_high = some_low[~single], some_high[~single]
            rows, widest = np.arange(len(some_low)), (some_high - some_low).argmax(axis=1) if len(some_low) else np.zeros(0, int)
            middle = (some_low[rows, widest] + some_high[rows, widest]) // 2
            left, right = some_high.copy(), some_low.copy()
            left[rows, widest], right[rows, widest] = middle, middle + 1
            new_low, new_high = self.tightened(np.concatenate([some_low, right]), np.concatenate([left, some_high]))
            low, high = np.concatenate([low[rest], new_low]), np.concatenate([high[rest], new_high])
            bound = np.concatenate([bound[rest], self.upper(new_low, new_high)])
        return best, cuts


def first_boxes(places: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Boxes of ranges of the places 1 to ``places``, which together hold every increasing set."""
    edges = np.unique(np.linspace(0, places, cells + 1).astype(int))
    lows, highs = edges[:-1] + 1, edges[1:]
    pick = np.array([(a, b, c, d) for a in range(len(lows)) for b in range(a, len(lows)) for c in range(b, len(lows)) for d in range(c, len(lows))])
    return lows[pick], highs[pick]


RESULT = pa.schema([("value", pa.float64()), *[(t, pa.int32()) for t in NAMES]])


def threshold_optimum(df: DataFrame, score: str = "score", label: str = "label", f1_weight: float = 0.4, step: int = 1) -> DataFrame:
    """One row ``t1..t4, objective``: the best increasing set on the grid of ``step`` hundredths, of equal ones the lowest."""
    if (HIGH - LOW) % step or step * 4 > HIGH - LOW:
        raise ValueError("the step must divide the range and leave room for four cuts")
    spark = df.sparkSession
    counts = thresholds.cumulative(thresholds.score_histogram(df, score, label))
    below = np.array(counts.first()["below"])  # labels x score bins
    bounds = Bounds(below, step, f1_weight)
    places = (HIGH - LOW) // step + 1
    # A first good set: the best of a coarser grid.
    coarse = max(1, places // 20)
    grid = np.arange(1, places + 1, coarse)
    quads = np.array([(a, b, c, d) for i, a in enumerate(grid) for j, b in enumerate(grid[i + 1:], i + 1)
                      for k, c in enumerate(grid[j + 1:], j + 1) for d in grid[k + 1:]])
    values = bounds.upper(quads, quads)
    at = int(np.flatnonzero(values >= values.max() - TIE)[0])
    best, cuts = float(values[at]), tuple(quads[at].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                boxes = np.array([batch.column(k).to_numpy() for k in range(8)]).T.astype(int)
                value, found = bounds.search(boxes[:, :4], boxes[:, 4:], best, cuts)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((value, *found), RESULT)], schema=RESULT)

    low, high = first_boxes(places)
    boxes = spark.createDataFrame(np.hstack([low, high]).tolist(), ", ".join(f"{side}{k} int" for side in "lh" for k in range(4)))
    tasks = max(1, min(spark.sparkContext.defaultParallelism, len(low)))
    found = boxes.repartition(tasks).mapInArrow(run, "value double, t1 int, t2 int, t3 int, t4 int")
    candidates = found.select(*[(LOW + (F.col(t) - 1) * step).alias(t) for t in NAMES]).distinct()
    chosen = thresholds.best_candidate(candidates, counts.scalar(), f1_weight)
    return chosen.select(*[(F.col(t) / float(STEP)).alias(t) for t in NAMES], "objective")
