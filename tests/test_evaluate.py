"""Scores and the threshold search against plain numpy."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paperloom.functions import labels as L, text
from paperloom.operators import evaluate, thresholds

QUICK = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
PAIRS = st.lists(st.tuples(st.integers(1, 5), st.integers(1, 5)), min_size=2, max_size=60)


def np_qwk(y, p):
    y, p = np.array(y), np.array(p)
    o = np.zeros((5, 5))
    for a, b in zip(y, p):
        o[a - 1, b - 1] += 1
    w = np.subtract.outer(np.arange(5), np.arange(5)) ** 2
    e = np.outer(o.sum(1), o.sum(0)) / len(y)
    return 1 - (w * o).sum() / (w * e).sum() if (w * e).sum() else None


def np_f1(y, p):
    y, p = np.array(y), np.array(p)
    f = [2 * ((y == k) & (p == k)).sum() / ((y == k).sum() + (p == k).sum()) for k in sorted(set(y) | set(p))]
    return float(np.mean(f))


@QUICK
@given(pairs=PAIRS)
def test_scores(spark, pairs):
    df = spark.createDataFrame(pairs, "label int, prediction int")
    y, p = zip(*pairs)
    row = evaluate.scores(df).first()
    expected = np_qwk(y, p)
    assert row["qwk"] == (None if expected is None else pytest.approx(expected))
    assert row["macro_f1"] == pytest.approx(np_f1(y, p))
    assert row["accuracy"] == pytest.approx(np.mean(np.array(y) == np.array(p)))
    swapped = df.agg(evaluate.qwk("prediction", "label")).first()[0]
    assert swapped == (None if expected is None else pytest.approx(expected))
    if len(set(y)) > 1:
        assert df.agg(evaluate.qwk("label", "label")).first()[0] == pytest.approx(1.0)


def test_class_weights(spark):
    counts = {1: 904, 2: 514, 3: 439, 4: 367, 5: 272}
    rows = [(k,) for k, n in counts.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "label int")
    got = {r["label"]: r["weight"] for r in evaluate.class_weights(df).collect()}
    assert [round(got[k], 4) for k in sorted(got)] == [0.4715, 0.8292, 0.9709, 1.1614, 1.5670]
    assert sum(got.values()) == pytest.approx(5)
    total = evaluate.balanced_weight(df).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(len(rows))
    with pytest.raises(PySparkException):
        evaluate.class_weights(df.where("label < 5")).collect()


def test_report_skips_absent_labels(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (4, 1)], "label int, prediction int")
    got = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert set(got) == {"1", "2", "4", "accuracy", "macro avg", "weighted avg"}
    assert got["4"]["f1"] == 0.0 and got["1"]["precision"] == 0.5 and got["macro avg"]["support"] == 4


def test_threshold_search_beats_every_coarse_grid_point(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(1, 6, 400)
    score = y * 0.7 + 0.9 + rng.normal(scale=0.4, size=400)
    df = spark.createDataFrame([(float(s), int(v)) for s, v in zip(score, y)], "score double, label int")
    best = thresholds.threshold_search(df).first()

    def value(cuts):
        p = 1 + (score[:, None] >= np.array(cuts)).sum(1)
        return 0.6 * np_qwk(y, p) + 0.4 * np_f1(y, p)

    cuts = [best[t] for t in thresholds.NAMES]
    assert cuts == sorted(cuts)
    assert best["objective"] == pytest.approx(value(cuts), abs=1e-8)
    grid = [1 + 0.5 * i for i in range(9)]
    assert all(best["objective"] >= value(c) - 0.02 for c in itertools.combinations(grid, 4))
    applied = df.select("label", L.apply_thresholds("score", cuts).alias("prediction"))
    assert applied.agg(evaluate.combined_objective("label", "prediction")).first()[0] == pytest.approx(
        best["objective"], abs=1e-8)


@QUICK
@given(texts=st.lists(st.text(max_size=40), min_size=1, max_size=8))
def test_cleaning_twice_changes_nothing(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = df.select(text.clean_text("t").alias("t"))
    assert [r[0] for r in once.select(text.clean_text("t")).collect()] == [r[0] for r in once.collect()]


def test_labels_outside_the_usual_set_are_counted(spark):
    df = spark.createDataFrame([(1, 9), (9, 1), (2, 2), (None, 1)], "label int, prediction int")
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(df).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 3 and cells[1, 9] == cells[9, 1] == cells[2, 2] == 1
    report = {r["class"]: r["support"] for r in evaluate.classification_report(df).collect()}
    assert report["9"] == 1 and report["macro avg"] == 3
    with pytest.raises(PySparkException):
        df.agg(evaluate.macro_f1("label", "prediction")).collect()


def test_missing_scores_are_left_out(spark):
    rows = [(0.5, 1), (None, 5), (4.9, 5)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert sorted((r["label"], r["n"]) for r in thresholds.score_histogram(df).collect()) == [(1, 1), (5, 1)]
    labels = df.select(L.apply_thresholds("score"), L.clamp(F.col("score"))).collect()
    assert [tuple(r) for r in labels] == [(1, 1.0), (None, None), (5, 4.9)]
