"""Every registered query against its SQL equivalent on the smallest tables."""

from __future__ import annotations

import pytest
from check import compare, connect
from conftest import SMALL

from paperloom.plans import REGISTRY

EXACT = [name for name, q in REGISTRY.items() if q.sql is not None]
# Queries whose rows cannot be written in SQL; test_models.py checks what they promise.
FITTED = [name for name, q in REGISTRY.items() if q.sql is None]


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", EXACT)
def test_equals_sql(spark, duck, name):
    got = REGISTRY[name].run(spark, SMALL).toArrow()
    assert compare(got, duck.execute(REGISTRY[name].sql).to_arrow_table()) == []


def test_only_fits_lack_sql():
    assert set(FITTED) <= {
        "feature_union", "dense_embedding", "standardize_pca", "logreg", "svm", "naive_bayes",
        "boosted_trees", "ordinal_regression", "tune_C", "grid_search_cv", "oof_assemble",
        "cv_ensemble", "ordinal_ensemble", "model_persist", "boosted_ensemble", "knn_index",
        "ordinal_joint", "svm_rbf", "threshold_optimum_fine", "latent_embedding", "features_persist",
    }


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert {"column", "missing_count", "missing_ratio"} == set(rows[0].asDict())
