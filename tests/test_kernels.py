"""Kernel features, calibrated pairs and the joint ordinal model."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from paperloom.operators import evaluate, joint, kernels, models


def frame(spark, x, labels):
    rows = [(i, int(t), [float(v) for v in r]) for i, (r, t) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>").repartition(3)
    return df.select("id", "label", (F.col("label") - 1).cast("double").alias("target"), array_to_vector("v").alias("features"))


@pytest.fixture(scope="module")
def ring():
    rng = np.random.default_rng(1)
    angle, inner = rng.uniform(0, 2 * np.pi, 300), rng.random(300) < 0.5
    radius = np.where(inner, 1.0, 3.0) + 0.2 * rng.normal(size=300)
    return np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]), np.where(inner, 1, 2)


def test_features_approximate_the_kernel(spark, ring):
    x, labels = ring
    df = frame(spark, x, labels)
    exact = kernels.radial(x, x, 0.5)
    for landmarks, most, mean in ((300, 1e-5, 1e-6), (60, 0.5, 0.01)):
        out = kernels.KernelMap(landmarks, 0.5).fit(df).transform(df).select("id", "kernel").collect()
        mapped = np.array([r["kernel"].toArray() for r in sorted(out)])
        error = np.abs(mapped @ mapped.T - exact)
        assert error.max() < most and error.mean() < mean
    assert kernels.scale_gamma(df) == pytest.approx(1 / (2 * x.var()))


def test_a_ring_is_separated(spark, ring, tmp_path):
    x, labels = ring
    df = frame(spark, x, labels)
    linear = models.linear_svm(1.0, 300, 30).fit(models.weighted(df))
    fitted = kernels.kernel_svm(10.0, 60).fit(df)
    scores = [models.predict(m, df).agg(evaluate.accuracy("label", "prediction")).first()[0] for m in (linear, fitted)]
    assert scores[0] < 0.75 and scores[1] > 0.97
    fitted.write().overwrite().save(str(tmp_path / "m"))
    ours, theirs = (sorted((r["id"], *r["probability"].toArray().round(9)) for r in m.transform(df).collect())
                    for m in (fitted, PipelineModel.load(str(tmp_path / "m"))))
    assert ours == theirs and all(sum(r[1:]) == pytest.approx(1) for r in ours)


def test_coupling_recovers_consistent_chances():
    p = np.random.default_rng(2).dirichlet(np.ones(5), 50)
    r = p[:, :, None] / (p[:, :, None] + p[:, None, :])
    assert np.allclose(kernels.couple(r), p)


def test_probabilities_are_reliable(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2400, 2))
    chance = 1 / (1 + np.exp(-2 * x[:, 0]))
    labels = np.where(rng.random(2400) < chance, 2, 1)
    df = frame(spark, x, labels)
    model = kernels.CalibratedPairs(1.0, 3, features="features").fit(df.where("id < 1200"))
    rows = model.transform(df.where("id >= 1200")).collect()
    said = np.array([r["probability"][1] for r in rows])
    true = np.array([r["label"] == 2 for r in rows])
    for decile in np.array_split(np.argsort(said), 10):
        assert abs(said[decile].mean() - true[decile].mean()) < 0.13
    assert np.abs(said - chance[[r["id"] for r in rows]]).mean() < 0.05


def test_one_label_only(spark, ring):
    df = frame(spark, ring[0], np.full(300, 3))
    out = kernels.kernel_svm(landmarks=10).fit(df).transform(df).select("probability", "prediction").distinct().collect()
    assert [(list(r["probability"]), r["prediction"]) for r in out] == [([0, 0, 1, 0, 0], 2.0)]


def test_gradient_agrees_with_differences():
    rng = np.random.default_rng(7)
    shape = joint.Shape(3, 4)
    w, x = rng.normal(size=shape.size), rng.normal(size=(20, 3))
    y, weight = rng.integers(0, 5, 20), rng.random(20) + 0.5
    _, gradient = joint.loss_and_gradient(w, x, y, weight, shape)
    for i in range(shape.size):
        step = np.eye(shape.size)[i] * 1e-6
        up, down = (joint.loss_and_gradient(w + s, x, y, weight, shape)[0] for s in (step, -step))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_joint_model_beats_separate_heads(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 3))
    level = x[:, 0] ** 2 + x[:, 1] + 0.2 * rng.normal(size=600)
    df = frame(spark, x, 1 + np.searchsorted(np.quantile(level, [0.2, 0.4, 0.6, 0.8]), level))
    train, test = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    model = joint.joint_ordinal(train, hidden=8, steps=50)
    assert all(b <= a for a, b in zip(model.losses, model.losses[1:])) and len(model.losses) > 5
    kappa = []
    for scored in (model.score(test), models.ordinal_regression(train).score(test)):
        rounded = F.greatest(F.lit(1), F.least(F.lit(5), F.round("score"))).cast("int")
        kappa.append(scored.withColumn("p", rounded).agg(evaluate.qwk("label", "p")).first()[0])
    assert kappa[0] >= kappa[1] and kappa[0] > 0.7
    model.save(str(tmp_path / "joint"))
    loaded = joint.JointModel.load(spark, str(tmp_path / "joint"))
    ours, theirs = ({r["id"]: r["score"] for r in m.score(test).collect()} for m in (model, loaded))
    assert ours == theirs and all(1 <= s <= 5 for s in ours.values())
