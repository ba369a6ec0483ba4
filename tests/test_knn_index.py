"""Inverted lists against the exact neighbours."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from paperloom.operators import knn, knn_index
from paperloom.plans import REGISTRY
from paperloom.sources import tables


def pairs(df):
    return {(r["id"], r["neighbour_id"]) for r in df.select("id", "neighbour_id").collect()}


def test_recall_on_the_whole_table(spark):
    vectors = tables.vectors(spark, SMALL).select("id", "embedding")
    found = REGISTRY["knn_index"].run(spark, SMALL)
    queries = vectors.where("id % 20 = 0")
    exact = pairs(knn.knn_join(queries, vectors, 5))
    rows = found.collect()
    assert len(rows) == 5 * queries.count() and {r["rank"] for r in rows} == {1, 2, 3, 4, 5}
    assert len({(r["id"], r["neighbour_id"]) for r in rows} & exact) >= 0.9 * len(exact)


def test_all_lists_give_the_exact_neighbours(spark, monkeypatch):
    monkeypatch.setattr(knn_index, "BLOCK", 16)
    monkeypatch.setattr(knn_index, "GROUP", 4)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300, [0.0] * 8), (301, None)]
    rows += [(400 + i, rows[7][1]) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    index = knn_index.build(df, cells=6)
    assert index.lists.count() == len(rows) - 1
    assert index.lists.groupBy("cell", "block").count().agg(F.max("count")).first()[0] < 60
    queries = df.where("id % 20 = 0")
    got = knn_index.search(index, queries, df, 4, probes=6, refine=20)
    want = knn.knn_join(queries, df.dropna(), 4)
    far = {(r["id"], r["rank"]): r["distance"] for r in want.collect()}
    assert {(r["id"], r["rank"]): r["distance"] for r in got.collect()} == pytest.approx(far)
    assert 1 <= knn_index.calibrated_probes(index, queries, df.dropna(), 4) <= 6


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, embedding array<double>")
    assert knn_index.search(knn_index.build(df), df, df).collect() == []


def test_blocks_reach_python_a_few_at_a_time(spark, monkeypatch):
    """A row is a block of codes with a group of queries; their number in a batch is bounded, the result is not touched."""
    table = tables.vectors(spark, SMALL).select("id", "embedding")
    index = knn_index.build(table, cells=4)
    queries = table.where("id % 20 == 0")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, used = spark.conf.get(setting), []
    real = knn_index.materialize
    monkeypatch.setattr(knn_index, "materialize", lambda df, name: (used.append((name, spark.conf.get(setting))), real(df, name))[1])
    want = sorted(map(tuple, knn_index.candidates(index, queries, 4, 10).collect()))
    assert ("index-found", str(knn_index.PAIRS)) in used and spark.conf.get(setting) == before
    monkeypatch.setattr(knn_index, "PAIRS", 1)
    assert sorted(map(tuple, knn_index.candidates(index, queries, 4, 10).collect())) == want
