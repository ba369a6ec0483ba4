"""Trees under one softmax loss, against a plain booster on one machine."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paperloom.operators import boosting, evaluate, models

PLAIN = {"rows": 1.0, "columns": 1.0, "bins": 16}


def frame(spark, x, y, held=None):
    rows = [(i, int(t) + 1, float(t), [float(v) for v in r], bool(held[i]) if held is not None else False) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, label int, target double, v array<double>, held boolean").repartition(3)
    return df.withColumn("features", array_to_vector("v")).drop("v")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    score = x[:, 0] + x[:, 1] * (x[:, 2] > 0) + 0.3 * rng.normal(size=400)
    return x, np.searchsorted(np.quantile(score, [0.2, 0.4, 0.6, 0.8]), score)


def plain_boost(bins, y, s, base):
    """Losses and margins: exhaustive search over all splits, best leaf first."""
    margins, losses = np.tile(base, (len(y), 1)), []
    for _ in range(s.rounds):
        p = boosting.softmax(margins)
        losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        new = margins.copy()
        for k in range(s.labels):
            g, h = p[:, k] - (y == k), p[:, k] * (1 - p[:, k])

            def best(rows):
                found = None
                gain0 = g[rows].sum() ** 2 / (h[rows].sum() + s.penalty)
                for f in range(bins.shape[1]):
                    for b in range(s.bins):
                        left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                        if min(len(left), len(right)) < s.least_rows or min(h[left].sum(), h[right].sum()) < s.least_curvature:
                            continue
                        gain = sum(g[r].sum() ** 2 / (h[r].sum() + s.penalty) for r in (left, right)) - gain0
                        if round(gain, 9) > 0 and (found is None or round(gain, 9) > found[0]):
                            found = (round(gain, 9), left, right)
                return found

            leaves, total = [(np.arange(len(y)), 0)], 1
            splits = {0: best(leaves[0][0])}
            while True:
                open_ = [(splits[i][0], -i, i) for i, (rows, d) in enumerate(leaves) if rows is not None and d < s.depth and splits[i]]
                if not open_ or s.leaves is not None and total >= s.leaves:
                    break
                i = max(open_)[2]
                depth = leaves[i][1] + 1
                for rows in splits[i][1:]:
                    splits[len(leaves)] = best(rows)
                    leaves.append((rows, depth))
                leaves[i] = (None, 0)
                total += 1
            if total > 1:
                for rows, _ in leaves:
                    if rows is not None:
                        new[rows, k] -= s.rate * g[rows].sum() / (h[rows].sum() + s.penalty)
        margins = new
    return losses, margins


@pytest.mark.parametrize("leaves", [None, 3])
def test_equals_a_plain_booster(spark, data, leaves):
    x, y = data
    s = boosting.Settings(rounds=3, depth=2, leaves=leaves, rate=0.3, least_rows=5, **PLAIN)
    df = frame(spark, x, y)
    model = boosting.SoftmaxTrees(s).fit(df)
    borders = boosting.bin_borders(df, "features", s.bins)
    bins = np.column_stack([np.searchsorted(b, x[:, k]) for k, b in enumerate(borders)])
    base = np.log(np.bincount(y, minlength=5) / len(y))
    losses, margins = plain_boost(bins, y, s, base)
    assert [a for a, _ in model.losses[:3]] == pytest.approx(losses)
    assert all(b < a for (a, _), (b, _) in zip(model.losses, model.losses[1:]))  # falls each round
    got = {r["id"]: r["probability"].toArray() for r in model.transform(df).select("id", "probability").collect()}
    want = boosting.softmax(margins)
    assert all(np.allclose(got[i], want[i]) for i in range(len(y)))


def test_stops_on_held_rows_and_is_saved(spark, data, tmp_path):
    x, y = data
    noise = np.random.default_rng(5).integers(0, 5, len(y))
    s = boosting.Settings(rounds=30, depth=2, rate=0.8, patience=2, least_curvature=0.0, **PLAIN)
    df = frame(spark, x, noise, held=np.arange(len(y)) % 4 == 0)
    estimator = boosting.SoftmaxTrees(s, held="held")
    estimator.write().overwrite().save(str(tmp_path / "e"))
    model = boosting.SoftmaxTrees.load(str(tmp_path / "e")).fit(df)
    held = [b for _, b in model.losses]
    assert len(held) < 31 and len(model.rounds) == int(np.argmin(held)) == len(held) - 1 - s.patience
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = boosting.SoftmaxTreesModel.load(str(tmp_path / "m"))
    ours, theirs = (sorted(tuple(r) for r in m.transform(df).select("id", "prediction").collect()) for m in (model, loaded))
    assert ours == theirs


def test_at_least_as_good_as_separate_boosters(spark, data):
    x, y = data
    df = frame(spark, x, y)
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    joint = boosting.SoftmaxTrees(boosting.Settings(rounds=30, depth=3, rate=0.2)).fit(train)
    apart = models.boosted_trees(spark, rounds=6, depth=2, rate=0.3).fit(train)
    scores = [models.predict(m, test).agg(evaluate.macro_f1("label", "prediction")).first()[0] for m in (joint, apart)]
    assert scores[0] >= scores[1] and scores[0] > 0.4


def test_margins_are_carried_over_checkpoints(spark, data, monkeypatch):
    x, y = data
    df = frame(spark, x, y)
    s = boosting.Settings(rounds=4, depth=1, rate=0.3)
    once = [a for a, _ in boosting.SoftmaxTrees(s).fit(df).losses]
    monkeypatch.setattr(boosting, "CHECKPOINT", 1)
    assert [a for a, _ in boosting.SoftmaxTrees(s).fit(df).losses] == pytest.approx(once)


def test_no_rows(spark, data):
    with pytest.raises(ValueError, match="no rows"):
        boosting.SoftmaxTrees(boosting.Settings(rounds=1)).fit(frame(spark, *data).where("id < 0"))


def test_folds_grow_side_by_side(spark, data, monkeypatch):
    """The trees of all models share the jobs, and each model is what it is alone."""
    x, y = data
    frames = [frame(spark, x, y, held=np.arange(len(y)) % 3 == k) for k in range(2)]
    settings = boosting.Settings(rounds=6, depth=2, rate=0.3, patience=2, **PLAIN)
    estimator = boosting.SoftmaxTrees(settings, held="held")
    jobs, plain = [], boosting._best_splits
    monkeypatch.setattr(boosting, "_best_splits", lambda *a: jobs.append(1) or plain(*a))
    both = estimator.fit_side_by_side(frames)
    together = len(jobs)
    alone = [estimator.fit(f) for f in frames]
    assert together <= 2 * 6 + 1 and together < len(jobs) - together
    for one, other in zip(both, alone):
        assert np.allclose(one.losses, other.losses) and len(one.rounds) == len(other.rounds)


def test_sums_of_a_level_are_one_row_a_cell(spark, data):
    """What is shuffled does not grow with the number of bins."""
    x, y = data
    s = boosting.Settings(rounds=1, depth=1, **PLAIN)
    _, path = boosting._start(frame(spark, x, y), s, 0, "features", "target", None, None)
    growth = boosting.Growth(boosting.Fit([[]] * 4, np.zeros(5)), [], [boosting.Tree.of_depth(1) for _ in range(5)])
    sums = boosting._level_sums(spark.read.schema(boosting.STATE).parquet(path).coalesce(1), s, 4, {0: growth}, 0, 0, [np.arange(4)] * 5)
    assert sums.count() == 2 + 5 * 4


def test_rows_travel_in_blocks(spark, data, monkeypatch):
    """The table of the rows has a row for each block, and the blocks of a model are joined again."""
    x, y = data
    s = boosting.Settings(rounds=1, depth=1, **PLAIN)
    monkeypatch.setattr(boosting, "ROWS", 50)
    fit, path = boosting._start(frame(spark, x, y, held=np.arange(len(y)) % 4 == 0).coalesce(1), s, 3, "features", "target", None, "held")
    state = spark.read.schema(boosting.STATE).parquet(path)
    assert state.count() == 8
    batches = state.toArrow().to_batches()
    assert not list(boosting._rows(batches, {0}))
    for least, parts in ((0, 8), (120, 3), (10_000, 1)):
        found = list(boosting._rows(batches, {3}, least))
        nr, bins, target, weight, held, margins = (np.concatenate(c) for c in zip(*[rows for _, rows in found]))
        assert len(found) == parts and {m for m, _ in found} == {3} and len(set(nr.tolist())) == 400
        assert np.bincount(target).tolist() == np.bincount(y).tolist() and held.sum() == 100 and (weight == 1).all()
        assert bins.shape == (400, 4) and sorted(bins[:, 0]) == sorted(np.searchsorted(fit.borders[0], x[:, 0]))
        assert np.allclose(margins, np.tile(fit.base, (400, 1)))


def test_leaves_are_those_of_a_walk_down():
    rng = np.random.default_rng(8)
    columns = rng.integers(0, 9, (200, 3)).astype(np.uint8)
    tree = boosting.Tree.of_depth(4)
    tree.feature[:15], tree.cut[:15] = rng.integers(-1, 3, 15), rng.integers(0, 9, 15)
    tree.feature[0] = 1
    for levels in range(5):
        want = []
        for row in columns:
            node = 0
            for _ in range(levels):
                if tree.feature[node] >= 0:
                    node = 2 * node + 1 + (row[tree.feature[node]] > tree.cut[node])
            want.append(node)
        assert tree.leaves(columns, tree.cut, levels).tolist() == want
