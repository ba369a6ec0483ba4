"""Fitted queries: shape, label domain, and quality above the majority class."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SMALL
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from paperloom.functions.stopwords import english_stop_words
from paperloom.operators import evaluate, folds, margins, metadata, models, stages, terms
from paperloom.plans import REGISTRY
from paperloom.session import scratch_path
from paperloom.sources import io, tables


def majority(df):
    return df.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]


@pytest.mark.parametrize("name", ["logreg", "svm", "naive_bayes", "boosted_trees", "tune_C", "model_persist"])
def test_classifiers(spark, name):
    out = REGISTRY[name].run(spark, SMALL)
    rows = out.collect()
    assert {r["prediction"] for r in rows} <= {1, 2, 3, 4, 5}
    assert len({r["id"] for r in rows}) == len(rows) == len([r for r in rows if r["label"] is not None])
    if name == "model_persist":
        assert all((r["score"], r["prediction"]) == (r["score_before"], r["prediction_before"]) for r in rows)


def clustered(spark):
    """Rows whose label follows from the features, with some noise."""
    noise = lambda seed: (F.rand(seed) - 0.5) * 0.6
    label = (F.col("id") % 5 + 1).cast("int")
    return models.model_input(spark.range(250).select(
        "id", label.alias("label"),
        F.array(label + noise(1), label * label + noise(2), noise(3)).alias("embedding"),
    ).repartition(2))


def test_models_learn(spark):
    rows = clustered(spark)
    n = rows.count()
    floor = majority(rows) + 0.2
    fits = {
        "logreg": models.logreg(10.0, n, 100).fit(models.weighted(rows)),
        "svm": models.linear_svm(10.0, n, 30).fit(models.weighted(rows)),
        "trees": models.boosted_trees(spark, rounds=4, depth=2, rows=1.0, columns=1.0).fit(rows),
    }
    for name, model in fits.items():
        score = models.predict(model, rows).agg(evaluate.accuracy("label", "prediction")).first()[0]
        assert score > floor, (name, score)


def test_ensembles(spark, tmp_path):
    rows = clustered(spark)
    ensemble = models.cv_ensemble(rows, lambda n: models.logreg(10.0, n, 50), folds=3)
    oof = ensemble.oof.collect()
    assert sorted(r["id"] for r in oof) == list(range(250))
    assert all(sum(r["probability"]) == pytest.approx(1.0) for r in oof)
    predicted = models.ensemble_predict(ensemble, rows)
    joined = predicted.join(rows.select("id", "label"), "id")
    assert joined.agg(evaluate.accuracy("label", "prediction")).first()[0] > 0.6

    ordinal = models.ordinal_ensemble(rows, folds=3, c=10.0, max_iter=30)
    assert list(ordinal.cuts) == sorted(ordinal.cuts)
    labelled = models.ordinal_predict(ordinal, rows.select("id", "features")).join(rows.select("id", "label"), "id")
    assert labelled.agg(evaluate.qwk("label", "prediction")).first()[0] > 0.7
    folder = str(tmp_path / "ordinal")
    models.save_ordinal(ordinal, folder)
    assert models.load_cuts(spark, folder) == ordinal.cuts
    again = models.load_ordinal(spark, folder, 3)
    ours = {r["id"]: r["score"] for r in models.ordinal_predict(ordinal, rows).collect()}
    theirs = {r["id"]: r["score"] for r in models.ordinal_predict(again, rows).collect()}
    assert theirs == pytest.approx(ours)


def test_grid_search(spark):
    score, chosen, model = models.grid_search_cv(clustered(spark), (1, 2), (5.0,), folds=2, max_iter=10)
    assert 0 < score <= 1 and chosen["k"] in (1, 2)
    assert models.predict(model, clustered(spark)).count() == 250


def test_classifiers_fitted_side_by_side_equal_single_fits(spark):
    """The same weights as one fit each, to nine digits, in two groups, with a label that one of them lacks."""
    rows = models.weighted(clustered(spark)).withColumn("pca", F.col("features"))
    groups = {0: rows.cache(), 1: rows.where((F.col("target") != 1) & (F.col("id") % 3 > 0)).cache()}
    points = [margins.Point(0, 2, 0.01), margins.Point(1, 3, 0.1)]
    found = margins.fit_side_by_side(groups, points, 12)
    for point, weights in zip(points, found):
        cut = VectorSlicer(inputCol="pca", outputCol="used", indices=list(range(point.size))).transform(groups[point.group].coalesce(1))
        assert len(weights) == 5 and not weights[:, point.size:-1].any()
        for label, w in enumerate(weights):
            if label not in (0, 3):
                continue
            one = LinearSVC(regParam=point.penalty, maxIter=12, standardization=False, featuresCol="used", labelCol="y", weightCol="weight")
            single = one.fit(cut.withColumn("y", (F.col("target") == label).cast("double")))
            assert list(w[:point.size]) == pytest.approx(list(single.coefficients.toArray()), rel=1e-6, abs=1e-8)
            assert w[-1] == pytest.approx(single.intercept, rel=1e-6, abs=1e-8)


def test_predictions_of_all_points_are_those_of_the_first_largest_margin(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])], "label int, x array<double>")
    rows = rows.select("label", array_to_vector("x").alias("pca"))
    weights = [np.array([[1.0, 0.0, 0.0], [0.0, 1.0, 0.0]]), np.array([[0.0, 0.0, 0.0], [0.0, 0.0, 1.0]])]
    got = {(r["label"], r["point"]): r["prediction"] for r in margins.predictions(rows, weights).collect()}
    assert got == {(1, 0): 1, (2, 0): 2, (3, 0): 1, (1, 1): 2, (2, 1): 2, (3, 1): 2}


def test_tfidf_stage_equals_the_table_form(spark):
    papers = tables.paper_texts(spark, SMALL)
    stop = english_stop_words()
    block = stages.TfidfBlock(inputCol="abstract", outputCol="v", maxFeatures=500, stopWords=list(stop))
    model = block.fit(papers)
    folder = scratch_path(spark, "tfidf")
    model.save(folder)
    vectors = PipelineModel.load(folder).transform(papers)
    from_stage = {r[0]: r[1] for r in vectors.select("id", F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x)).collect()}
    table = terms.tfidf(papers, "abstract", stop_words=stop, min_df=2, max_df=0.9, max_features=500)
    from_table = {r[0]: r[1] for r in table.groupBy("id").agg(F.sum("weight")).collect()}
    assert len(from_stage) == papers.count()
    for key, total in from_stage.items():
        assert total == pytest.approx(from_table.get(key, 0.0))


def test_feature_union(spark):
    rows = REGISTRY["feature_union"].run(spark, SMALL).collect()
    assert len({r["width"] for r in rows}) == 1 and rows[0]["width"] > 8


def test_feature_union_gives_the_vectors_of_both_splits(spark, tmp_path):
    """Every paper comes with its split and its whole vector, found by what the training papers hold."""
    words = ["river", "forest", "copper", "meadow"]
    texts = [f"{words[i % 4]} {words[i % 3]}. {words[i // 2 % 4]} stone {words[i % 2]} {i % 7}x" for i in range(30)]
    documents = [(i, None if i == 4 else t, "en", None if i == 5 else f"src{i % 9}", 100 + 700 * (i % 6)) for i, t in enumerate(texts)]
    lines = [(i, 1 + (i + k) % 3, None) for i in range(25) for k in range(i % 3)]
    names = [(k, f"Supplier#{k}", None, None) for k in (1, 2, 3)]
    for table, rows in (("documents", documents), ("lineitem", lines), ("supplier", names)):
        spark.createDataFrame(rows, io.TABLES[table]).write.parquet(str(tmp_path / f"{table}.parquet"))
    rows = REGISTRY["feature_union"].run(spark, str(tmp_path)).collect()
    papers = folds.with_split(tables.papers(spark, str(tmp_path)))
    expected = {r["id"]: (r["label"], r["split"]) for r in papers.collect()}
    assert {s for _, s in expected.values()} == {"train", "test"} and len(expected) == 30
    assert sorted((r["id"], r["label"], r["split"]) for r in rows) == sorted((k, *v) for k, v in expected.items())
    fitted = stages.feature_union(english_stop_words()).fit(papers.where("split = 'train'"))
    for part in ("train", "test"):
        vectors = fitted.transform(papers.where(F.col("split") == part)).select("id", vector_to_array("features").alias("v"))
        wanted = {r["id"]: r["v"] for r in vectors.collect()}
        for r in rows:
            if r["split"] == part:
                got = np.zeros(r["width"])
                got[r["indices"]] = r["values"]
                assert got.tolist() == pytest.approx(wanted[r["id"]])
    text = [np.square([v for i, v in zip(r["indices"], r["values"]) if i < r["width"] - 8]).sum() for r in rows if r["split"] == "train"]
    assert all(x == pytest.approx(round(x)) for x in text) and max(text) == pytest.approx(3.0)  # a unit vector for each block


def test_metadata_model_is_saved(spark, tmp_path):
    papers = tables.papers(spark, SMALL)
    model = stages.MetadataFeatures().fit(papers)
    model.save(str(tmp_path / "m"))
    loaded = stages.MetadataFeaturesModel.load(str(tmp_path / "m"))
    columns = ["id", vector_to_array("metadata").alias("m")]
    ours = {r["id"]: r["m"] for r in model.transform(papers).select(*columns).collect()}
    theirs = {r["id"]: r["m"] for r in loaded.transform(papers).select(*columns).collect()}
    assert ours.keys() == theirs.keys() and len(ours) == papers.count()
    assert all(theirs[k] == pytest.approx(v) for k, v in ours.items())


def test_fitted_feature_pipeline_is_saved(spark, tmp_path):
    papers = tables.papers(spark, SMALL)
    fitted = stages.feature_union(english_stop_words(), title=50, abstract=80, author=20).fit(papers)
    fitted.write().overwrite().save(str(tmp_path / "union"))
    loaded = PipelineModel.load(str(tmp_path / "union"))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("t")
    ours, theirs = ({r["id"]: r["t"] for r in m.transform(papers).select("id", total).collect()} for m in (fitted, loaded))
    assert ours.keys() == theirs.keys() and all(theirs[k] == pytest.approx(v) for k, v in ours.items())


def test_boosted_trees_are_saved(spark, tmp_path):
    rows = clustered(spark)
    trees = models.boosted_trees(spark, rounds=2, depth=2)
    trees.write().overwrite().save(str(tmp_path / "trees"))
    fitted = stages.BoostedTrees.load(str(tmp_path / "trees")).fit(rows)
    fitted.write().overwrite().save(str(tmp_path / "fitted"))
    loaded = stages.BoostedTreesModel.load(str(tmp_path / "fitted"))
    ours, theirs = (sorted(map(tuple, models.predict(m, rows).collect())) for m in (fitted, loaded))
    assert ours == theirs and len(ours) == 250


def test_cleaning_pipeline_round_trip(spark, tmp_path):
    papers = tables.papers(spark, SMALL)
    pipeline = stages.cleaning_stages()
    pipeline.write().overwrite().save(str(tmp_path / "p"))
    out = Pipeline.load(str(tmp_path / "p")).fit(papers).transform(papers)
    assert out.where("title is null or abstract is null or authors is null or year is null").count() == 0


def test_evaluators(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (2.0, 1.0)], "target double, prediction double")
    for make in (stages.MacroF1Evaluator, stages.KappaEvaluator, stages.ObjectiveEvaluator):
        score = make(labelCol="target", predictionCol="prediction").evaluate(df)
        assert 0 < score < 1


def test_vectors_of_fitted_queries(spark):
    pca = REGISTRY["standardize_pca"].run(spark, SMALL).first()
    assert len(pca["components"]) == 30
    dense = REGISTRY["dense_embedding"].run(spark, SMALL).collect()
    norms = [sum(x * x for x in r["embedding"]) for r in dense]
    assert all(n == pytest.approx(1.0, abs=1e-4) or n == 0 for n in norms) and any(norms)


def test_submission_rejects_a_label_outside_the_domain(spark):
    df = spark.createDataFrame([(1, 6)], "id long, prediction int")
    with pytest.raises(Exception, match="outside the domain"):
        io.submission(df, "prediction").collect()


def test_scaler_of_a_constant_column(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0)], "id long, x double")
    out = metadata.standardise(df, metadata.scaler_stats(df, ["x"]), ["x"]).collect()
    assert [r["x"] for r in out] == [0.0, 0.0]
