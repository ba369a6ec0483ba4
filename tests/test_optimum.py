"""Branch and bound against full enumeration."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from paperloom.operators import optimum, thresholds
from paperloom.operators.optimum import Bounds


def objective(count, cuts, weight=0.4):
    """From the table of truth and said, by the definitions."""
    edges = [0, *cuts, count.shape[1] - 1]
    table = np.array([[count[i][b] - count[i][a] for a, b in zip(edges, edges[1:])] for i in range(5)])
    n, truth, said = table.sum(), table.sum(axis=1), table.sum(axis=0)
    square = np.array([[(i - j) ** 2 for j in range(5)] for i in range(5)])
    expected = (square * np.outer(truth, said)).sum()
    kappa = 1 - n * (square * table).sum() / expected if expected else 0.0
    f1 = [2 * table[i][i] / (truth[i] + said[i]) for i in range(5) if truth[i] + said[i]]
    return (1 - weight) * kappa + weight * (sum(f1) / len(f1) if f1 else 0.0)


def counts(seed, kind, places=403):
    rng = np.random.default_rng(seed)
    n = np.zeros((5, places - 1), int)
    for i in range(5):
        if kind == "sparse" and i % 2:
            continue
        scores = np.clip(rng.normal(1 + i, 0.9, 60 if kind == "sparse" else 400), 0.99, 5.01)
        if kind == "sparse":
            scores = scores.round(1)
        np.add.at(n[i], np.clip((scores * 100).astype(int) - 99, 0, places - 2), 1)
    return np.concatenate([np.zeros((5, 1), int), n.cumsum(axis=1)], axis=1)


@pytest.mark.parametrize("kind", ["dense", "sparse", "empty"])
@settings(max_examples=6, deadline=None, derandomize=True)
@given(seed=st.integers(0, 10_000))
def test_equals_enumeration_on_a_coarse_grid(kind, seed):
    below = counts(seed, kind) if kind != "empty" else np.zeros((5, 403), int)
    bounds = Bounds(below, 25, 0.4)
    places = 17
    every = [(round(objective(bounds.count, c), 9), c) for c in combinations(range(1, places + 1), 4)]
    top = max(v for v, _ in every)
    want = min(c for v, c in every if v >= top - 1e-9)
    first = (1, 2, 3, 17)
    value, got = bounds.search(*optimum.first_boxes(places, 3), objective(bounds.count, first), first)
    assert value == pytest.approx(top) and got == want


@settings(max_examples=30, deadline=None, derandomize=True)
@given(st.integers(0, 10_000), st.data())
def test_no_set_in_a_box_beats_its_bound(seed, data):
    bounds = Bounds(counts(seed, "dense"), 10, 0.4)
    a = sorted(data.draw(st.lists(st.integers(1, 41), min_size=4, max_size=4, unique=True)))
    b = sorted(data.draw(st.lists(st.integers(1, 41), min_size=4, max_size=4, unique=True)))
    low, high = np.minimum(a, b), np.maximum(a, b)
    upper = bounds.upper(low[None], high[None])[0]
    for cuts in (a, b):
        exact = objective(bounds.count, cuts)
        assert exact <= upper + 1e-12
        assert bounds.upper(np.array([cuts]), np.array([cuts]))[0] == pytest.approx(exact)


def test_never_below_the_coarse_search(spark):
    rng = np.random.default_rng(5)
    labels = rng.integers(1, 6, 3000)
    rows = [(int(t), float(s)) for t, s in zip(labels, labels + rng.normal(0, 0.8, 3000))]
    df = spark.createDataFrame([*rows, (3, None), (None, 2.0)], "label int, score double").repartition(3)
    best, near = optimum.threshold_optimum(df).first(), thresholds.threshold_search(df).first()
    assert best["objective"] >= near["objective"]
    assert best["t1"] < best["t2"] < best["t3"] < best["t4"]
    with pytest.raises(ValueError):
        optimum.threshold_optimum(df, step=30)
