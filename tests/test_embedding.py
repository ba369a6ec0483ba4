"""Learned vectors against a dense decomposition."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql.types import LongType, StructField, StructType

from paperloom.operators import embedding

SCHEMA = StructType([StructField("id", LongType()), StructField("v", VectorUDT())])


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    x = rng.random((60, 30)) * (rng.random((60, 30)) < 0.3)
    x[7] = 0
    return x


def frame(spark, x):
    rows = [(i, Vectors.dense(r) if i % 5 == 0 else SparseVector(len(r), np.flatnonzero(r).tolist(), r[r != 0].tolist())) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_singular_values_and_vectors(spark, table, tmp_path):
    df = frame(spark, table)
    model = embedding.LatentTerms("v", size=6, steps=200).fit(df)
    _, singular, right = np.linalg.svd(table, full_matrices=False)
    assert model.singular == pytest.approx(singular[:6], abs=1e-6)
    assert np.abs(np.diag(right[:6] @ model.directions)) == pytest.approx(np.ones(6), abs=1e-4)
    got = {r["id"]: np.array(r["embedding"]) for r in model.transform(df).collect()}
    for i, row in enumerate(table):
        want = row @ model.directions
        length = np.linalg.norm(want)
        assert np.allclose(got[i], want / length if length else 0.0)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = {r["id"]: r["embedding"] for r in embedding.LatentTermsModel.load(str(tmp_path / "m")).transform(df).collect()}
    assert all(np.allclose(again[i], got[i]) for i in got)


def test_more_directions_than_terms_and_no_rows(spark, table):
    few = table[:, :3]
    model = embedding.LatentTerms("v", size=8).fit(frame(spark, few))
    assert model.singular == pytest.approx(np.linalg.svd(few, compute_uv=False), abs=1e-6)
    assert embedding.LatentTerms("v").fit(frame(spark, few).limit(0)).transform(frame(spark, few).limit(0)).collect() == []


def test_an_unbounded_vocabulary_is_refused(spark):
    df = spark.createDataFrame([(1, SparseVector(200_000, [5], [1.0]))], SCHEMA)
    with pytest.raises(ValueError, match="limit the vocabulary"):
        embedding.LatentTerms("v").fit(df)


def test_parts_of_a_batch_add_up(spark, table, monkeypatch):
    """Rows are multiplied in parts of bounded size; a long row is a part of its own, and empty rows are kept."""
    import pyarrow as pa

    lists = [np.flatnonzero(r) for r in table]
    at = pa.array([[99], *[x.tolist() for x in lists]], pa.list_(pa.int32()))[1:]
    values = pa.array([[9.0], *[r[r != 0].tolist() for r in table]], pa.list_(pa.float64()))[1:]
    block = np.random.default_rng(1).random((30, 4))
    for part in (1, 7, 1000):
        monkeypatch.setattr(embedding, "PART", part)
        found = list(embedding._products(at, values, block))
        assert np.allclose(np.vstack([x[-1] for x in found]), table @ block)
        assert [x[0].start for x in found[1:]] == [x[0].stop for x in found[:-1]] and found[-1][0].stop == 60
    assert part == 1000 and len(found) == 1


def test_a_step_reads_one_direction_at_a_time(spark, table, monkeypatch):
    """No array of entries times directions is built, and a block wider than a part gives the same sums."""
    at, values = embedding.sparse_parts("v")
    rows = frame(spark, table).select(at.alias("at"), values.alias("values"))
    block = np.random.default_rng(4).random((30, 5))
    for part in (1, 29, 1 << 15):
        monkeypatch.setattr(embedding, "PART", part)
        assert np.allclose(embedding.LatentTerms("v")._step(rows, block, 30), table.T @ (table @ block))
    rng = np.random.default_rng(6)
    index = pa.array(list(rng.integers(0, 500, (50, 200)).astype(np.int32)), pa.list_(pa.int32()))
    weight = pa.array(list(rng.random((50, 200))), pa.list_(pa.float64()))
    wide = np.asfortranarray(rng.random((500, 80)))
    tracemalloc.start()
    (_, _, _, _, out), = embedding._products(index, weight, wide)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.shape == (50, 80) and most < 10_000 * 80 * 8 / 4
