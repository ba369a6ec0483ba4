"""Classifiers on Spark ML: fitting, tuning, cross-validation and persistence.

Labels are 1..5 in the data and 0..4 inside the models.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, LogisticRegressionModel, NaiveBayes, OneVsRest,
)
from pyspark.ml.feature import PCA, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import vectors as V
from ..functions.labels import LABELS, apply_thresholds, ordinal_targets
from ..session import materialize, shared_dir
from . import margins
from .evaluate import balanced_weight, macro_f1
from .folds import oof_assemble, with_folds
from .stages import BoostedTrees, NonNegative
from .thresholds import NAMES, threshold_search

# The penalties that are tried.
C_GRID = (0.1, 0.5, 1.0, 5.0, 10.0)


def model_input(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    """``id, label, target, features``: an array column as vector, labels from 0."""
    return df.select(
        "id",
        "label",
        (F.col("label") - 1).cast("double").alias("target"),
        array_to_vector(F.col(embedding).cast("array<double>")).alias("features"),
    )


def weighted(df: DataFrame) -> DataFrame:
    """Add the class-balanced ``weight``; its total is the number of rows."""
    return balanced_weight(df, "label")


def logreg(c: float, n_rows: int, max_iter: int = 2000) -> LogisticRegression:
    """Multinomial logistic regression; ``c`` is the inverse penalty per row."""
    return LogisticRegression(
        featuresCol="features", labelCol="target", weightCol="weight", family="multinomial",
        regParam=1.0 / (c * n_rows), maxIter=max_iter, standardization=False,
    )


def linear_svm(c: float, n_rows: int, max_iter: int = 200, features: str = "features") -> OneVsRest:
    """One linear margin classifier per label."""
    base = LinearSVC(regParam=1.0 / (c * n_rows), maxIter=max_iter, standardization=False)
    return OneVsRest(
        classifier=base, featuresCol=features, labelCol="target", weightCol="weight", parallelism=len(LABELS)
    )


def naive_bayes() -> Pipeline:
    """Scale to [0, 1] by the training range, then multinomial naive Bayes."""
    return Pipeline(stages=[
        MinMaxScaler(inputCol="features", outputCol="scaled"),
        NonNegative(inputCol="scaled", outputCol="unit"),
        NaiveBayes(featuresCol="unit", labelCol="target", modelType="multinomial"),
    ])


def boosted_trees(spark: SparkSession, rounds: int = 500, depth: int = 6, rate: float = 0.05,
                  rows: float = 0.8, columns: float = 0.8, tolerance: float = 0.01,
                  held: str | None = None) -> BoostedTrees:
    """Gradient-boosted trees, with early stop on the rows marked by ``held``."""
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    stop = {"validationIndicatorCol": held, "validationTol": tolerance} if held else {}
    booster = GBTClassifier(
        featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
        featureSubsetStrategy=str(columns), seed=42, checkpointInterval=10, cacheNodeIds=True, **stop,
    )
    return BoostedTrees(booster, len(LABELS), held)


def standardize_pca(k: int, features: str = "features") -> list:
    """Stages: zero mean and unit deviation, then the first k components in ``pca``."""
    return [
        StandardScaler(inputCol=features, outputCol="scaled", withMean=True),
        PCA(k=k, inputCol="scaled", outputCol="pca"),
    ]


def feature_concat(blocks: Sequence[DataFrame], columns: Sequence[str], out: str = "features") -> DataFrame:
    """Join feature blocks on ``id`` and put their columns into one vector, in order."""
    joined = blocks[0]
    for block in blocks[1:]:
        joined = joined.join(block, "id")
    assembled = VectorAssembler(inputCols=list(columns), outputCol=out).transform(joined)
    return assembled.select("id", out)


def predict(model: Model, df: DataFrame) -> DataFrame:
    """``id, label, prediction`` with labels from 1."""
    scored = model.transform(df)
    return scored.select("id", "label", (F.col("prediction") + 1).cast("int").alias("prediction"))


def _macro_f1_of(predictions: DataFrame) -> float:
    return predictions.agg(macro_f1("label", "prediction")).first()[0]


@dataclass(frozen=True)
class Tuned:
    c: float
    macro_f1: float
    model: Model


def tune_c(train: DataFrame, valid: DataFrame, make: Callable[[float, int], Estimator],
           grid: Sequence[float] = C_GRID, parallelism: int = 4) -> Tuned:
    """Best penalty by macro-F1 on the validation part; the first best one wins.

    The final model is then fitted on both parts.
    """
    parts = materialize(
        train.withColumn("valid", F.lit(False)).unionByName(valid.withColumn("valid", F.lit(True))),
        "tuning",
    )
    fit_rows = weighted(parts.where(~F.col("valid")))
    held = parts.where("valid")
    n = parts.where(~F.col("valid")).count()

    def score(c: float) -> float:
        return _macro_f1_of(predict(make(c, n).fit(fit_rows), held))

    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(train.sparkSession)(score), grid)
    best = max(range(len(grid)), key=lambda i: (scores[i], -i))
    final = make(grid[best], parts.count()).fit(weighted(parts))
    return Tuned(grid[best], scores[best], final)


def grid_search_cv(df: DataFrame, components: Sequence[int], cs: Sequence[float], folds: int = 5,
                   max_iter: int = 200, parallelism: int = 4) -> tuple[float, dict, PipelineModel]:
    """Best macro-F1 over PCA size and penalty on stratified folds, and the refitted pipeline.

    The first k components of a larger projection are the projection to k, so each fold needs
    one PCA, and every grid point uses its first entries. All points of all folds are fitted side by
    side. Sizes beyond the length of the vectors mean all of it. Of equal scores the first grid point wins.
    """
    width = df.select(F.max(F.size(vector_to_array("features")))).first()[0]
    components = list(dict.fromkeys(min(k, width) for k in components))
    rows = materialize(with_folds(weighted(df), folds), "grid")
    points = [(k, c) for k in components for c in cs]

    def project(f: int) -> DataFrame:
        projection = Pipeline(stages=standardize_pca(max(components))).fit(rows.where(F.col("fold") != f))
        return materialize(projection.transform(rows).select("label", "target", "weight", "fold", "pca"), "projected")

    with ThreadPool(parallelism) as pool:
        projected = pool.map(inheritable_thread_target(df.sparkSession)(project), range(folds))
    train = {f: p.where(F.col("fold") != f) for f, p in enumerate(projected)}
    counts = {f: t.count() for f, t in train.items()}
    fits = [margins.Point(f, k, 1.0 / (c * counts[f])) for f in range(folds) for k, c in points]
    weights = margins.fit_side_by_side(train, fits, max_iter)
    said = None
    for f, p in enumerate(projected):
        own = margins.predictions(p.where(F.col("fold") == f), weights[f * len(points):(f + 1) * len(points)])
        own = own.withColumn("fold", F.lit(f))
        said = own if said is None else said.unionByName(own)
    # One row for each fold and grid point.
    scores = said.groupBy("fold", "point").agg(macro_f1("label", "prediction").alias("score")).collect()
    if len(scores) < len(fits):
        raise ValueError("a fold without rows")
    totals = [0.0] * len(points)
    for r in sorted(scores, key=lambda r: r["fold"]):
        totals[r["point"]] += r["score"] / folds
    at = max(range(len(points)), key=lambda i: (totals[i], -i))
    k, c = points[at]
    stages = [*standardize_pca(k), linear_svm(c, rows.count(), max_iter, features="pca")]
    return totals[at], {"k": k, "C": c}, Pipeline(stages=stages).fit(rows)


# --- cross-validated ensembles ------------------------------------------------------------


@dataclass(frozen=True)
class Ensemble:
    """Fold models and their out-of-fold probabilities."""

    models: list[Model]
    oof: DataFrame


def _probabilities(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df).select(
        "id", "label", vector_to_array("probability").alias("probability")
    )


def cv_ensemble(df: DataFrame, make: Callable[[int], Estimator], folds: int = 5,
                parallelism: int = 4, held: str | None = None) -> Ensemble:
    """One model per fold, fitted on the other folds; each row is scored by the model that was not fitted on it.

    With ``held``, the rows of the fold go along, marked by a column of that name, to stop the fit.
    """
    rows = materialize(with_folds(df, folds), "folds")
    spark = df.sparkSession
    n = rows.count()

    def seen(k: int) -> DataFrame:
        fitted = weighted(rows.where(F.col("fold") != k))
        if not held:
            return fitted
        return fitted.withColumn(held, F.lit(False)).unionByName(
            rows.where(F.col("fold") == k).withColumns({"weight": F.lit(1.0), held: F.lit(True)}), allowMissingColumns=True)

    def fit(k: int) -> Model:
        return make(n).fit(seen(k))

    together = getattr(make(n), "fit_side_by_side", None)
    if together:
        models = together([seen(k) for k in range(folds)])
    else:
        with ThreadPool(min(parallelism, folds)) as pool:
            models = pool.map(inheritable_thread_target(spark)(fit), range(folds))
    parts = {k: _probabilities(m, rows.where(F.col("fold") == k)) for k, m in enumerate(models)}
    return Ensemble(models, oof_assemble(parts))


def ensemble_predict(ensemble: Ensemble, df: DataFrame) -> DataFrame:
    """``id, probability, prediction``: mean of the fold models, then the likeliest label.

    The models are applied side by side to the same row, so averaging needs no shuffle.
    """
    out = df.select("id", "features")
    names = []
    for i, model in enumerate(ensemble.models):
        name = f"p_{i}"
        scored = model.transform(out)
        extra = [c for c in scored.columns if c not in out.columns]
        out = scored.withColumn(name, vector_to_array("probability")).drop(*extra)
        names.append(name)
    size = len(LABELS)
    mean = F.array(*[sum((F.col(n)[j] for n in names), F.lit(0.0)) / len(names) for j in range(size)])
    averaged = out.select("id", mean.alias("probability"))
    return averaged.withColumn("prediction", V.argmax_label("probability") + 1)


@dataclass(frozen=True)
class OrdinalModel:
    """Four cumulative heads and one five-class head, blended into an expected level."""

    heads: list[Model]
    classes: Model
    gamma: float

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``score``; all heads are applied to the same row."""
        out = df
        logits = []
        for i, head in enumerate(self.heads):
            before = out.columns
            scored = head.transform(out)
            logit = vector_to_array("rawPrediction")[1].alias(f"z_{i}")
            out = scored.select(*before, logit)
            logits.append(F.col(f"z_{i}"))
        before = df.columns
        scored = self.classes.transform(out)
        blended = V.ev_blend(
            V.ev_ordinal(F.array(*logits)), V.ev_softmax(vector_to_array("rawPrediction")), self.gamma
        )
        return scored.select(*before, blended.alias("score"))


def ordinal_regression(df: DataFrame, c: float = 1.0, gamma: float = 0.6,
                       max_iter: int = 100) -> OrdinalModel:
    """Fit the heads on class-balanced rows; one binary target per label border."""
    rows = materialize(weighted(df).withColumn("borders", ordinal_targets("label")), "ordinal")
    n = rows.count()

    def head(i: int) -> Model:
        binary = LogisticRegression(
            featuresCol="features", labelCol="border", weightCol="weight", family="binomial",
            regParam=1.0 / (c * n), maxIter=max_iter, standardization=False,
        )
        return binary.fit(rows.withColumn("border", F.col("borders")[i]))

    spark = df.sparkSession
    with ThreadPool(len(LABELS) - 1) as pool:
        heads = pool.map(inheritable_thread_target(spark)(head), range(len(LABELS) - 1))
    return OrdinalModel(heads, logreg(c, n, max_iter).fit(rows), gamma)


@dataclass(frozen=True)
class OrdinalEnsemble:
    models: list[OrdinalModel]
    cuts: tuple[float, ...]
    oof: DataFrame | None


def ordinal_ensemble(df: DataFrame, folds: int = 5, c: float = 1.0, max_iter: int = 100,
                     parallelism: int = 4) -> OrdinalEnsemble:
    """Fold models, their out-of-fold scores and the cut points found on those scores."""
    rows = materialize(with_folds(df, folds), "ordinal-folds")

    def fit(k: int) -> OrdinalModel:
        return ordinal_regression(rows.where(F.col("fold") != k), c, max_iter=max_iter)

    with ThreadPool(min(parallelism, folds)) as pool:
        models = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(folds))
    parts = {
        k: m.score(rows.where(F.col("fold") == k)).select("id", "label", "score")
        for k, m in enumerate(models)
    }
    oof = materialize(oof_assemble(parts), "oof")
    cuts = threshold_search(oof).first()
    return OrdinalEnsemble(models, tuple(cuts[t] for t in NAMES), oof)


def ordinal_predict(ensemble: OrdinalEnsemble, df: DataFrame) -> DataFrame:
    """``id, score, prediction``: mean score of the fold models, then the cut points."""
    out = df
    for i, model in enumerate(ensemble.models):
        out = model.score(out).withColumnRenamed("score", f"s_{i}")
    mean = sum((F.col(f"s_{i}") for i in range(len(ensemble.models))), F.lit(0.0)) / len(ensemble.models)
    scored = out.select("id", mean.alias("score"))
    return scored.withColumn("prediction", apply_thresholds("score", ensemble.cuts))


# --- persistence --------------------------------------------------------------------------


def save_models(models: Sequence[Model], folder: str) -> None:
    for i, model in enumerate(models):
        model.write().overwrite().save(f"{folder}/fold_{i}")


def load_models(loader, folder: str, n: int) -> list[Model]:
    """``loader`` is the model class, e.g. ``LogisticRegressionModel``."""
    return [loader.load(f"{folder}/fold_{i}") for i in range(n)]


def save_cuts(spark: SparkSession, cuts: Sequence[float], folder: str) -> None:
    row = spark.range(1).select(*[F.lit(float(c)).alias(t) for t, c in zip(NAMES, cuts)])
    row.write.mode("overwrite").parquet(f"{folder}/cuts")


def load_cuts(spark: SparkSession, folder: str) -> tuple[float, ...]:
    row = spark.read.parquet(f"{folder}/cuts").first()
    return tuple(row[t] for t in NAMES)


def save_ordinal(ensemble: OrdinalEnsemble, folder: str) -> None:
    spark = SparkSession.active()
    for i, model in enumerate(ensemble.models):
        save_models([*model.heads, model.classes], f"{folder}/model_{i}")
    save_cuts(spark, ensemble.cuts, folder)



def load_ordinal(spark: SparkSession, folder: str, folds: int, gamma: float = 0.6) -> OrdinalEnsemble:
    """The saved fold models and cut points; out-of-fold scores are not part of what is saved."""
    loaded = []
    for i in range(folds):
        *heads, classes = load_models(LogisticRegressionModel, f"{folder}/model_{i}", len(LABELS))
        loaded.append(OrdinalModel(heads, classes, gamma))
    return OrdinalEnsemble(loaded, load_cuts(spark, folder), None)
