"""Classifiers on the embedding vectors. Fits have no SQL equivalent; tests check their quality."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.stopwords import english_stop_words
from ..functions.vectors import argmax_label
from ..operators import boosting, folds, joint, kernels, models, stages
from ..session import materialize, scratch_path
from ..sources import tables
from .registry import query
from .sql import with_views


# The settings of the two kinds of boosted trees, and the grid that is searched.
DEEP = boosting.Settings(rounds=500, depth=6, rate=0.05, rows=0.8, columns=0.8, patience=50)
LEAFY = boosting.Settings(rounds=500, depth=3, leaves=5, rate=0.01, rows=0.8, columns=0.8, least_rows=30,
                          least_curvature=1e-3, penalty=0.0, patience=50)
GRID_COMPONENTS, GRID_C = (30, 50, 80, 120, 200), (0.5, 1.0, 5.0, 10.0)


def _input(spark, sf):
    return models.model_input(tables.vectors(spark, sf))


def _three_parts(spark, sf):
    """To fit, to choose by, and to score: no row is scored by a model that was chosen on it."""
    train, test = _split(spark, sf)
    parts = materialize(folds.with_split(train), "parts")
    return [*[parts.where(F.col("split") == s).drop("split") for s in ("train", "test")], test]


def _split(spark, sf):
    # Fitting passes over the rows many times, so the joined table is written first.
    marked = materialize(folds.with_split(_input(spark, sf)), "split")
    return [marked.where(F.col("split") == s).drop("split") for s in ("train", "test")]


@query("standardize_pca")
def standardize_pca(spark, sf):
    from pyspark.ml import Pipeline

    rows = _input(spark, sf)
    model = Pipeline(stages=models.standardize_pca(30)).fit(rows)
    return model.transform(rows).select("id", "label", vector_to_array("pca").alias("components"))


@query("logreg")
def logreg(spark, sf):
    train, test = _split(spark, sf)
    model = models.logreg(1.0, train.count()).fit(models.weighted(train))
    return models.predict(model, test)


@query("svm")
def svm(spark, sf):
    train, test = _split(spark, sf)
    model = models.linear_svm(1.0, train.count()).fit(models.weighted(train))
    return models.predict(model, test)


# Counts with one added, on entries scaled by the range of the training rows and cut below at 0.
BAYES_VIEWS = {
    "entries": """SELECT id, label, split, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(0, len(embedding))) AS i FROM vector_split""",
    "ranges": "SELECT i, min(v) AS lo, max(v) AS hi FROM entries WHERE split = 'train' GROUP BY i",
    "scaled": """SELECT id, label, split, e.i, greatest(CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0.5 END, 0) AS x
      FROM entries e JOIN ranges r ON r.i = e.i""",
    "sums": "SELECT label, i, sum(x) AS s FROM scaled WHERE split = 'train' GROUP BY label, i",
    "thetas": "SELECT label, i, ln(s + 1) - ln(sum(s) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label)) AS theta FROM sums",
    "priors": """SELECT label, ln(count(*) + 1) - ln(sum(count(*)) OVER () + count(*) OVER ()) AS prior
      FROM vector_split WHERE split = 'train' GROUP BY label""",
    "scores": """SELECT t.id, t.label, p.label AS prediction, any_value(prior) + sum(x * theta) AS score
      FROM scaled t JOIN thetas h ON h.i = t.i JOIN priors p ON p.label = h.label WHERE t.split = 'test' GROUP BY t.id, t.label, p.label""",
}


@query("naive_bayes", with_views(
    """SELECT id, label, prediction FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, prediction) AS r FROM scores) WHERE r = 1""",
    "vector_split", **BAYES_VIEWS))
def naive_bayes(spark, sf):
    train, test = _split(spark, sf)
    return models.predict(models.naive_bayes().fit(train), test)


@query("boosted_trees")
def boosted_trees(spark, sf):
    """Trees under one softmax loss, with early stop on a part that is neither fitted nor scored."""
    train, held, test = _three_parts(spark, sf)
    rows = train.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))
    return models.predict(boosting.SoftmaxTrees(DEEP, held="held").fit(rows), test)


@query("boosted_ensemble")
def boosted_ensemble(spark, sf):
    """One booster of few leaves per fold, stopped on that fold; mean of the fold models on the test split."""
    train, test = _split(spark, sf)
    ensemble = models.cv_ensemble(train, lambda n: boosting.SoftmaxTrees(LEAFY, held="held"), held="held")
    return models.ensemble_predict(ensemble, test)


@query("svm_rbf")
def svm_rbf(spark, sf):
    """Radial kernel machine with calibrated probabilities."""
    train, test = _split(spark, sf)
    scored = kernels.kernel_svm(1.0).fit(train).transform(test)
    return scored.select("id", "label", (F.col("prediction") + 1).cast("int").alias("prediction"),
                         vector_to_array("probability").alias("probability"))


@query("ordinal_joint")
def ordinal_joint(spark, sf):
    """Both heads on one representation, fitted under one loss."""
    train, test = _split(spark, sf)
    return joint.joint_ordinal(train).score(test).select("id", "label", "score")


@query("ordinal_regression")
def ordinal_regression(spark, sf):
    train, test = _split(spark, sf)
    model = models.ordinal_regression(train)
    return model.score(test).select("id", "label", "score")


@query("tune_C")
def tune_c(spark, sf):
    train, held, test = _three_parts(spark, sf)
    tuned = models.tune_c(train, held, lambda c, n: models.logreg(c, n))
    best = models.predict(tuned.model, test)
    return best.withColumns({"best_c": F.lit(tuned.c), "macro_f1": F.lit(tuned.macro_f1)})


@query("grid_search_cv")
def grid_search_cv(spark, sf):
    train, test = _split(spark, sf)
    score, chosen, model = models.grid_search_cv(train, components=GRID_COMPONENTS, cs=GRID_C, folds=5)
    return models.predict(model, test).withColumns(
        {"cv_macro_f1": F.lit(score), "k": F.lit(chosen["k"]), "c": F.lit(chosen["C"])})


def _ensemble(train):
    return models.cv_ensemble(train, lambda n: models.logreg(1.0, n))


@query("oof_assemble")
def oof_assemble(spark, sf):
    """Every record with the probabilities of the model that had not seen it."""
    oof = _ensemble(_input(spark, sf)).oof
    return oof.withColumn("prediction", argmax_label("probability") + 1)


@query("cv_ensemble")
def cv_ensemble(spark, sf):
    """Mean of the fold models on the test split."""
    train, test = _split(spark, sf)
    return models.ensemble_predict(_ensemble(train), test)


@query("ordinal_ensemble")
def ordinal_ensemble(spark, sf):
    """Fold models, cut points from the out-of-fold scores, labels for the test split."""
    train, test = _split(spark, sf)
    ensemble = models.ordinal_ensemble(train, folds=5)
    return models.ordinal_predict(ensemble, test)


@query("model_persist")
def model_persist(spark, sf):
    """Save a whole ordinal ensemble with its cut points, load it, and predict with both."""
    train, test = _split(spark, sf)
    folder = scratch_path(spark, "model")
    fitted = models.ordinal_ensemble(train, folds=5)
    models.save_ordinal(fitted, folder)
    loaded = models.load_ordinal(spark, folder, 5)
    before = models.ordinal_predict(fitted, test).withColumnsRenamed({"score": "score_before", "prediction": "prediction_before"})
    after = models.ordinal_predict(loaded, test)
    cuts = F.lit(",".join(map(str, loaded.cuts)))
    both = after.join(before, "id").join(test.select("id", "label"), "id")
    return both.select("id", "label", "score", "prediction", "score_before", "prediction_before", cuts.alias("cuts"))


@query("features_persist")
def features_persist(spark, sf):
    """Save the fitted feature pipeline, load it, and compare the sums of both vectors of each record."""
    from pyspark.ml import PipelineModel

    # Three fits and two transforms pass over the papers; their joins run once.
    papers = materialize(tables.papers(spark, sf), "papers")
    folder = scratch_path(spark, "features")
    fitted = stages.feature_union(english_stop_words()).fit(papers)
    fitted.save(folder)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    before, after = (m.transform(papers).select("id", F.round(total, 9).alias(name))
                     for m, name in ((fitted, "total_before"), (PipelineModel.load(folder), "total")))
    return after.join(before, "id")
