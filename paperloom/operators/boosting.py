"""Gradient-boosted trees for several labels under one softmax loss.

Every round grows one tree per label from the gradients of the joint loss. Rows are cut into bins of
each feature once and written in blocks. A level of the trees is one job: each task sums gradients, curvatures
and rows by (label, node, feature, bin), one shuffle brings the sums of a (label, node, feature), one row for all bins, together,
and the best split of each node is chosen from running totals over the bins. Only splits, at most one per
node and task, come to the driver. Growth is best first: the splits of all levels are known, and those with the highest gain are
kept until the tree has its number of leaves.

Margins are written again every ``CHECKPOINT`` rounds, so that neither the plan nor the number of trees
that a task applies grows, and a lost executor costs one level. The margins before are then deleted.

Several boosters, such as those of the folds, grow side by side: a level of all their trees is one job.
"""

from __future__ import annotations

from collections.abc import Container, Iterator, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vectors import argmax_label
from ..session import remove, scratch_path
from .stages import _WithParts

CHECKPOINT = 5
BINS = 64
ROWS = 2048  # rows in a block at most
BLOCK = 1 << 15  # rows of a booster that a task sums at a time
TASK_BLOCKS = 128  # blocks that a task reads, where they are more than the cores
ACCURACY = 10_000


@dataclass
class Tree:
    """Nodes in heap order: the feature split on (-1: none), its last bin to the left, and the value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size))

    def leaves(self, columns: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` steps; ``columns`` are compared with ``cuts`` of the nodes.

        From the last nodes up, one comparison of a whole column a node: fastest where a column lies in one piece.
        """
        number = np.uint8 if len(self.feature) <= 256 else np.int64

        def below(node: int, steps: int):
            feature = self.feature[node]
            if steps == 0 or feature < 0:
                return number(node)
            left, right = below(2 * node + 1, steps - 1), below(2 * node + 2, steps - 1)
            return np.where(columns[:, feature] > cuts[node], right, left)

        return np.broadcast_to(below(0, levels), len(columns))


@dataclass(frozen=True)
class Settings:
    labels: int = 5
    rounds: int = 500
    depth: int = 6
    leaves: int | None = None
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    least_rows: int = 1
    least_curvature: float = 1.0
    penalty: float = 1.0
    bins: int = BINS
    patience: int = 50
    seed: int = 42


@dataclass
class Fit:
    """What a fit leaves: borders of the bins, first margins, trees of each round, and the losses."""

    borders: list[list[float]]
    base: np.ndarray
    rounds: list[list[Tree]] = field(default_factory=list)
    losses: list[tuple[float, float]] = field(default_factory=list)  # of fitted and of held rows before each round
    best: int = 0


def bin_borders(df: DataFrame, features: str, bins: int) -> list[list[float]]:
    """Inner borders of about equally filled bins, for each entry of the vectors."""
    probabilities = [k / bins for k in range(1, bins)]
    entries = df.select(F.posexplode(vector_to_array(features)).alias("feature", "value"))
    found = entries.groupBy("feature").agg(
        F.percentile_approx("value", probabilities, ACCURACY).alias("borders")).orderBy("feature").collect()
    return [sorted(set(r["borders"])) for r in found]


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def uniform(numbers: np.ndarray, seed: int) -> np.ndarray:
    """A number from 0 to 1 for each row number and seed, the same in every attempt."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 2 + 1) * 0xD1B54A32D192ED03 % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


# Rows travel in blocks: one row of the table has the numbers of up to ``ROWS`` rows of a booster, each kind in one piece,
# so neither reading nor handing them to Python costs anything for each row. ``at`` is the first row number.
STATE = "model int, at long, nr binary, bins binary, target binary, weight binary, held binary, margins binary"
STATE_KIND = pa.schema([("model", pa.int32()), ("at", pa.int64()),
                        *[(x, pa.binary()) for x in ("nr", "bins", "target", "weight", "held", "margins")]])
NUMBERS = (np.int64, np.uint8, np.int32, np.float64, np.bool_, np.float64)
SUMS = "label int, node int, feature int, sums binary"  # gradients, curvatures and rows by bin
SUMS_KIND = pa.schema([("label", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("sums", pa.binary())])
LOSS = -1  # the label under which the losses travel; node 2 m has the fitted rows of model m, 2 m + 1 the held ones


@dataclass
class Growth:
    """A booster in the making: trees that its margins do not hold yet, and those that grow now."""

    fit: Fit
    pending: list[list[Tree]] = field(default_factory=list)
    trees: list[Tree] = field(default_factory=list)
    splits: list[dict] = field(default_factory=list)


def _packed(column: pa.BinaryArray, kind: type, size: int) -> np.ndarray:
    """The values of a binary column, each ``size`` numbers of a kind, as rows of one array."""
    column = column.cast(pa.binary())
    first = int(np.frombuffer(column.buffers()[1], np.int32, 1, 4 * column.offset)[0])
    return np.frombuffer(column.buffers()[2], kind, len(column) * size, first).reshape(len(column), size)


def _binary(rows: np.ndarray) -> pa.BinaryArray:
    """A binary column of the rows of an array."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows[0].nbytes if len(rows) else 0)
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _block(model: int, rows: Sequence[np.ndarray]) -> pa.RecordBatch:
    values = [np.ascontiguousarray(x, kind).tobytes() for x, kind in zip(rows, NUMBERS)]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((model, int(rows[0][0]), *values), STATE_KIND)], schema=STATE_KIND)


def _rows(batches: Iterator[pa.RecordBatch], models: Container[int], least: int = 0) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Blocks of the wanted models: row numbers, bins, targets, weights, held and margins.

    With ``least``, blocks of a model are joined until they have so many rows; what is left comes at the end.
    """
    waiting: dict[int, list[list[np.ndarray]]] = {}

    def joined(m: int) -> tuple[int, list[np.ndarray]]:
        rows = [np.concatenate(x) for x in zip(*waiting.pop(m))]
        n = len(rows[0])
        return m, [x.reshape(n, -1) if i in (1, 5) else x for i, x in enumerate(rows)]

    for batch in batches:
        for i, m in enumerate(batch.column(0).to_pylist()):
            if m in models:
                waiting.setdefault(m, []).append(
                    [np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns[2:], NUMBERS)])
                if sum(len(x[0]) for x in waiting[m]) >= least:
                    yield joined(m)
    for m in list(waiting):
        yield joined(m)


def _applied(bins: np.ndarray, margins: np.ndarray, rounds: list[list[Tree]], depth: int) -> np.ndarray:
    for trees in rounds:
        for k, tree in enumerate(trees):
            margins[:, k] += tree.value[tree.leaves(bins, tree.cut, depth)]
    return margins


def _level_sums(state: DataFrame, s: Settings, width: int, growing: dict[int, Growth], level: int,
                number: int, allowed: list[np.ndarray]) -> DataFrame:
    """Sums by (label, node, feature) and bin over the nodes of one level of the trees in growth.

    Label k of model m is number ``m * labels + k``.
    """
    first = 2 ** level - 1
    shared = {m: (g.pending, g.trees) for m, g in growing.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        losses: dict[int, np.ndarray] = {}
        for m, (nr, bins, target, weight, held, margins) in _rows(batches, shared, BLOCK):
            pending, trees = shared[m]
            if m not in sums:
                sums[m] = [np.zeros((3, 2 ** level, len(a), s.bins)) for a in allowed]
                losses[m] = np.zeros((2, 2))
            fitted = ~held & (uniform(nr, s.seed * 1000 + number) < s.rows)
            if level:  # the losses need all rows, the sums those that are drawn
                bins, margins = bins[fitted], margins[fitted]
            bins, margins = np.asfortranarray(bins), np.array(margins, order="F")  # each feature in one piece
            chance = softmax(_applied(bins, margins, pending, s.depth))
            if level == 0:
                loss = -np.log(np.maximum(chance[np.arange(len(target)), target], 1e-300)) * weight
                for side, chosen in enumerate((~held, held)):
                    losses[m][side] += loss[chosen].sum(), weight[chosen].sum()
                bins, chance = bins.T[:, fitted].T, chance[fitted]
            target, weight = target[fitted], weight[fitted]
            for k in range(s.labels):
                node = trees[k].leaves(bins, trees[k].cut, level).astype(np.int64) - first
                used = node >= 0
                p, w, hit, by_feature = chance[:, k], weight, target == k, bins.T
                if not used.all():
                    p, w, hit, node, by_feature = p[used], w[used], hit[used], node[used], by_feature[:, used]
                start, values = node * s.bins, (w * (p - hit), w * p * (1 - p), None)
                for j, f in enumerate(allowed[k]):
                    at = start + by_feature[f]
                    for kind, value in enumerate(values):
                        sums[m][k][kind, :, j] += np.bincount(at, value, 2 ** level * s.bins).reshape(-1, s.bins)
        for m in sums:
            if level == 0:
                sides = np.zeros((2, 3, s.bins))
                sides[:, :2, 0] = losses[m]
                yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int32()) for x in ([LOSS] * 2, [2 * m, 2 * m + 1], [0, 0])], _binary(sides)],
                                                 schema=SUMS_KIND)
            parts = []
            for k in range(s.labels):
                cells = sums[m][k].reshape(3, -1, s.bins).transpose(1, 0, 2)
                at = np.flatnonzero(cells[:, 2].any(axis=1))
                parts.append((np.full(len(at), m * s.labels + k), at // len(allowed[k]) + first, allowed[k][at % len(allowed[k])], cells[at]))
            *keys, cells = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int32()) for x in keys], _binary(cells)], schema=SUMS_KIND)

    return state.mapInArrow(run, SUMS)


SPLIT = pa.schema([("label", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()),
                   *[(x, pa.float64()) for x in ("gain", "gl", "hl", "ga", "ha")]])
SPLIT_DDL = "label int, node int, feature int, bin int, gain double, gl double, hl double, ga double, ha double"


def best_of(sums: np.ndarray, s: Settings):
    """For each cell of ``sums`` (cell, kind, bin) the last bin to the left of its best split, and gain, sums to the left and of all."""
    gl, hl, nl = (sums[:, j].cumsum(axis=1) for j in range(3))
    ga, ha, na = (x[:, -1:] for x in (gl, hl, nl))
    gr, hr, nr = ga - gl, ha - hl, na - nl

    def gain(x, y):
        return x * x / np.where(y + s.penalty == 0, np.inf, y + s.penalty)

    value = np.round(gain(gl, hl) + gain(gr, hr) - gain(ga, ha), 9)
    fits = (nl >= s.least_rows) & (nr >= s.least_rows) & (hl >= s.least_curvature) & (hr >= s.least_curvature) & (value > 0)
    value = np.where(fits, value, -np.inf)
    best = value.argmax(axis=1)  # of equal ones the first
    at = np.arange(len(sums)), best
    return best, value[at], gl[at], hl[at], ga[:, 0], ha[:, 0]


def _best_splits(sums: DataFrame, s: Settings) -> list[dict]:
    """The best split of each (label, node), and the losses.

    Tasks have summed already, so the sums go straight to where they are added up: all of one (label, node,
    feature) meet in one task, which returns its best split of each node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, added = np.zeros((0, 3), np.int32), np.zeros((0, 3 * s.bins))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, np.stack([c.to_numpy() for c in batch.columns[:3]], axis=1)])
            added = np.concatenate([added, _packed(batch.column(3), np.float64, 3 * s.bins)])
            order = np.lexsort(keys.T[::-1])
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            keys, added = keys[first], np.add.reduceat(added[order], first, axis=0)
        if not len(keys):
            return
        added = added.reshape(-1, 3, s.bins)
        lost = keys[:, 0] == LOSS
        rows = [(*key, 0, 0.0, 0.0, 0.0, x[0, 0], x[1, 0]) for key, x in zip(keys[lost].tolist(), added[lost])]
        if not lost.all():
            best = best_of(added[~lost], s)
            found: dict[tuple, tuple] = {}
            for (label, node, feature), row in zip(keys[~lost].tolist(), zip(*[v.tolist() for v in best])):
                if row[1] > 0 and ((label, node) not in found or row[1] > found[label, node][4]):
                    found[label, node] = (label, node, feature, *row)
            rows += found.values()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), SPLIT)] if rows
                                         else [pa.array([], f.type) for f in SPLIT], schema=SPLIT)

    chosen: dict[tuple[int, int], dict] = {}
    for r in sums.repartition("label", "node", "feature").mapInArrow(run, SPLIT_DDL).collect():
        key = (r["label"], r["node"])
        if key not in chosen or (-r["gain"], r["feature"], r["bin"]) < tuple(chosen[key][x] * w for x, w in (("gain", -1), ("feature", 1), ("bin", 1))):
            chosen[key] = r.asDict()
    return list(chosen.values())


def _best_first(tree: Tree, splits: dict[int, object], s: Settings) -> None:
    """Keep the splits of highest gain up to the number of leaves; set the values of what is left."""
    chosen, reachable, leaves = set(), {0} & splits.keys(), 1
    while reachable and (s.leaves is None or leaves < s.leaves):
        node = max(reachable, key=lambda n: (splits[n]["gain"], -n))
        chosen.add(node)
        reachable = (reachable - {node}) | ({2 * node + 1, 2 * node + 2} & splits.keys())
        leaves += 1
    for node in splits:
        if node not in chosen:
            tree.feature[node] = -1
    for node in chosen:
        r = splits[node]
        for child, g, h in ((2 * node + 1, r["gl"], r["hl"]), (2 * node + 2, r["ga"] - r["gl"], r["ha"] - r["hl"])):
            tree.value[child] = -s.rate * g / (h + s.penalty)


def _start(df: DataFrame, s: Settings, model: int, features: str, target: str, weight: str | None,
           held: str | None) -> tuple[Fit, str]:
    """Bins and first margins of one booster, and where its rows are written."""
    rows = df.select(
        F.monotonically_increasing_id().alias("nr"), F.col(features).alias("v"), F.col(target).cast("int").alias("target"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
        F.coalesce(F.col(held), F.lit(False)).alias("held") if held else F.lit(False).alias("held"))
    borders = bin_borders(rows.where(~F.col("held")), "v", s.bins)
    counts = dict(rows.where(~F.col("held")).groupBy("target").agg(F.sum("weight")).collect())
    if not counts:
        raise ValueError("no rows to fit")
    share = np.array([counts.get(k, 0.0) for k in range(s.labels)]) / sum(counts.values())
    result = Fit(borders, np.log(np.maximum(share, 1e-6)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            bins = np.column_stack([np.searchsorted(b, values[:, k]) for k, b in enumerate(borders)]).astype(np.uint8)
            nr, target, weight, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            rows = (nr, bins, target, weight, held, np.tile(result.base, (n, 1)))
            for first in range(0, n, ROWS):
                yield _block(model, [x[first:first + ROWS] for x in rows])

    path = scratch_path(df.sparkSession, f"boosting-0-{model}")
    rows.withColumn("v", vector_to_array("v")).mapInArrow(cut, STATE).write.parquet(path)
    return result, path


def _forward(state: DataFrame, s: Settings, growing: dict[int, Growth]) -> DataFrame:
    """The rows of the boosters that still grow, their margins with the pending trees."""
    shared = {m: g.pending for m, g in growing.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m, (*rows, margins) in _rows(batches, shared):
            yield _block(m, (*rows, _applied(np.asfortranarray(rows[1]), margins.copy(), shared[m], s.depth)))

    return state.mapInArrow(run, STATE)


def fit_side_by_side(frames: list[DataFrame], s: Settings, *, features: str = "features", target: str = "target",
                     weight: str | None = None, held: str | None = None) -> list[Fit]:
    """A booster for each frame, all by the same settings and each stopped by its own losses.

    Boosts until the rounds are used up or the loss of the held rows has not fallen for ``patience`` rounds.
    """
    if s.bins > 256:
        raise ValueError("at most 256 bins")
    spark = frames[0].sparkSession

    def start(m: int) -> tuple[Fit, str]:
        return _start(frames[m], s, m, features, target, weight, held)

    with ThreadPool(len(frames)) as pool:
        started = pool.map(inheritable_thread_target(spark)(start), range(len(frames)))
    fits = [fit for fit, _ in started]
    paths = [path for _, path in started]
    width = len(fits[0].borders)
    state = spark.read.schema(STATE).parquet(*paths)
    parts = max(spark.sparkContext.defaultParallelism, state.count() // TASK_BLOCKS)
    dealt: set[int] = set()
    growing = {m: Growth(fit) for m, fit in enumerate(fits)}
    best_loss = [np.inf] * len(fits)
    for number in range(s.rounds + 1):
        if number % CHECKPOINT == 0:
            path = scratch_path(spark, f"boosting-{number}")
            rows = _forward(state, s, growing)
            if dealt != set(growing):  # each task has as many rows as the others, of few boosters, so that it sends few sums
                rows, dealt = rows.repartitionByRange(parts, "model", "at"), set(growing)
            rows.write.parquet(path)
            state = spark.read.schema(STATE).parquet(path)
            for old in paths:
                remove(spark, old)
            paths = [path]
            for growth in growing.values():
                growth.pending = []
        rng = np.random.default_rng([s.seed, number])
        kept = max(1, round(s.columns * width))
        allowed = [np.sort(rng.choice(width, kept, replace=False)) for _ in range(s.labels)]
        for growth in growing.values():
            growth.trees = [Tree.of_depth(s.depth) for _ in range(s.labels)]
            growth.splits = [{} for _ in range(s.labels)]
        for level in range(s.depth):
            found = _best_splits(_level_sums(state, s, width, growing, level, number, allowed), s)
            if level == 0:
                sides = {r["node"]: r["ga"] / r["ha"] if r["ha"] else np.nan for r in found if r["label"] == LOSS}
                for m, growth in list(growing.items()):
                    fit = growth.fit
                    fit.losses.append((sides.get(2 * m, np.nan), sides.get(2 * m + 1, np.nan)))
                    watched = fit.losses[-1][1 if held else 0]
                    if not watched >= best_loss[m]:
                        best_loss[m], fit.best = watched, number
                    if number == s.rounds or number - fit.best >= s.patience:
                        fit.rounds = fit.rounds[:fit.best]
                        del growing[m]
                if not growing:
                    for path in paths:
                        remove(spark, path)
                    return fits
            split = False
            for r in found:
                m, k = divmod(r["label"], s.labels)
                if m in growing:
                    split = True
                    growing[m].splits[k][r["node"]] = r
                    growing[m].trees[k].feature[r["node"]], growing[m].trees[k].cut[r["node"]] = r["feature"], r["bin"]
            if not split:
                break  # no node can be split
        for growth in growing.values():
            for tree, known in zip(growth.trees, growth.splits):
                _best_first(tree, known, s)
            growth.fit.rounds.append(growth.trees)
            growth.pending.append(growth.trees)
    return fits


def fit_trees(df: DataFrame, s: Settings, **options) -> Fit:
    return fit_side_by_side([df], s, **options)[0]


class SoftmaxTrees(Estimator, _WithParts):
    """Fits on ``features`` and the zero-based ``target``; rows marked by ``held`` stop the boosting."""

    def __init__(self, settings: Settings = Settings(), held: str | None = None, weight: str | None = None):
        super().__init__()
        self.chosen, self.held, self.weight = settings, held, weight

    def settings(self) -> dict:
        return {"chosen": vars(self.chosen), "held": self.held, "weight": self.weight}

    def save_parts(self, folder: str) -> None:
        """Everything is in the settings."""

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> SoftmaxTrees:
        return cls(Settings(**settings["chosen"]), settings["held"], settings["weight"])

    def _fit(self, df: DataFrame) -> SoftmaxTreesModel:
        return self._model(fit_trees(df, self.chosen, held=self.held, weight=self.weight))

    def fit_side_by_side(self, frames: list[DataFrame]) -> list[SoftmaxTreesModel]:
        """One model for each frame, grown together: as many jobs as the longest of them needs alone."""
        return [self._model(f) for f in fit_side_by_side(frames, self.chosen, held=self.held, weight=self.weight)]

    def _model(self, fit: Fit) -> SoftmaxTreesModel:
        cuts = [[np.array([fit.borders[f][c] if f >= 0 and c < len(fit.borders[f]) else np.inf for f, c in zip(t.feature, t.cut)])
                 for t in trees] for trees in fit.rounds]
        model = SoftmaxTreesModel(fit.rounds, cuts, fit.base, self.chosen.depth)
        model.losses = fit.losses
        return model


class SoftmaxTreesModel(Model, _WithParts):
    """Adds ``probability`` and ``prediction``."""

    losses: list[tuple[float, float]] = []

    def __init__(self, rounds: list[list[Tree]], cuts: list[list[np.ndarray]], base: np.ndarray, depth: int):
        super().__init__()
        self.rounds, self.cuts, self.base, self.depth = rounds, cuts, base, depth

    def settings(self) -> dict:
        return {"base": self.base.tolist(), "depth": self.depth, "rounds": len(self.rounds)}

    def save_parts(self, folder: str) -> None:
        nodes = [(r, k, n, int(t.feature[n]), float(c[n]), float(t.value[n]))
                 for r, (trees, cuts) in enumerate(zip(self.rounds, self.cuts)) for k, (t, c) in enumerate(zip(trees, cuts))
                 for n in range(len(t.value)) if t.feature[n] >= 0 or t.value[n]]
        ddl = "round int, label int, node int, feature int, cut double, value double"
        SparkSession.active().createDataFrame(nodes, ddl).write.mode("overwrite").parquet(f"{folder}/nodes")

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> SoftmaxTreesModel:
        base, depth = np.array(settings["base"]), settings["depth"]
        rounds = [[Tree.of_depth(depth) for _ in base] for _ in range(settings["rounds"])]
        cuts = [[np.full(2 ** (depth + 1) - 1, np.inf) for _ in base] for _ in rounds]
        for r in spark.read.parquet(f"{folder}/nodes").collect():  # the model itself
            tree = rounds[r["round"]][r["label"]]
            tree.feature[r["node"]], tree.value[r["node"]] = r["feature"], r["value"]
            cuts[r["round"]][r["label"]][r["node"]] = r["cut"]
        return cls(rounds, cuts, base, depth)


    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.rounds, self.cuts, self.base, self.depth))

        def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            rounds, cuts, base, depth = shared.value
            for batch in batches:
                n = len(batch)
                values = np.asfortranarray(batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)) if n else np.zeros((0, 1))
                out = np.tile(base, (n, 1))
                for trees, borders in zip(rounds, cuts):
                    for k, (tree, cut) in enumerate(zip(trees, borders)):
                        out[:, k] += tree.value[tree.leaves(values, cut, depth)]
                yield pa.array(softmax(out).tolist() if n else [], pa.list_(pa.float64()))

        scored = F.arrow_udf(score, "array<double>", F.ArrowUDFType.SCALAR_ITER)
        out = df.withColumn("_shares", scored(vector_to_array("features")))
        return out.withColumns({"probability": array_to_vector("_shares"),
                                "prediction": argmax_label("_shares").cast("double")}).drop("_shares")
