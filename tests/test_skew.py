"""Brute-force comparison on fixtures where one key holds a third of all rows or more."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import folds, knn, metadata, ordering, profile, skew, terms
from paperloom.session import materialize

random.seed(7)
KEYS = ["hot"] * 400 + [f"k{i % 90}" for i in range(500)] + [None] * 300
random.shuffle(KEYS)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(KEYS)), "id long, key string").repartition(5)


def test_lookup_join_spreads_and_keeps_all_rows(spark, rows):
    counts = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    table = counts.where("key <> 'k5'").withColumn("v", F.length("key"))
    got = skew.lookup_join(rows, table, "key", "n", "id", salts=8).collect()
    assert len(got) == len(KEYS)
    for r in got:
        assert r["v"] == (None if r["key"] in (None, "k5") else len(r["key"]))
    inner = skew.lookup_join(rows, table, "key", "n", "id", "inner", salts=8)
    assert inner.count() == sum(k not in (None, "k5") for k in KEYS)


def test_heavy_keys_are_spread_over_salts(rows):
    counts = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    plan = skew.lookup_join(rows, counts, "key", "n", "id", salts=8)
    text = plan._jdf.queryExecution().toString()
    assert "_salt" in text and "xxhash64(id" in text


@pytest.mark.parametrize("buckets", [2, 3, 16, 256])
def test_running_before(spark, buckets):
    weights = {i * 3 % 211: i + 1 for i in range(211)}
    keys = materialize(spark.createDataFrame(list(weights.items()), "k int, w long"), "t")
    got = {r["k"]: r["before"] for r in ordering.running_before(keys, "k", "w", buckets).collect()}
    total = 0
    for k in sorted(weights):
        assert got[k] == total
        total += weights[k]


def test_dense_index(rows):
    got = {r["key"]: (r["code"], r["n"]) for r in ordering.dense_index(rows, "key").collect()}
    names = sorted({k for k in KEYS if k})
    assert got == {k: (i, KEYS.count(k)) for i, k in enumerate(names)}


@pytest.mark.parametrize("data", [
    [1.0], [1.0, 2.0], [5.0] * 700 + [float(x) for x in range(300)], [0.5, -3.0, 2.25, 9.0, 9.0, 11.0, 11.5],
])
def test_quantiles(spark, monkeypatch, data):
    monkeypatch.setattr(ordering.running_before, "__defaults__", (8,))
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "x double").repartition(3)
    p = (0.0, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)
    got = ordering.quantiles(df, "x", p).first()[0]
    assert got == pytest.approx(list(np.quantile(data, p)))


def test_describe_matches_numpy(spark):
    data = [float(x % 17) for x in range(500)] + [3.0] * 250
    row = profile.describe(spark.createDataFrame([(x,) for x in data], "x double"), "x").first()
    expected = [len(data), np.mean(data), np.std(data, ddof=1), min(data), *np.quantile(data, [0.25, 0.5, 0.75]), max(data)]
    assert list(row) == pytest.approx(expected)


def test_folds_with_copied_ids(spark):
    pairs = [(1, 2)] * 300 + [(i, 1 + i % 5) for i in range(2, 400)]
    df = spark.createDataFrame(pairs, "id long, label int").repartition(4)
    got = folds.stratified_kfold(df).collect()
    assert len(got) == len(set(pairs))
    for label in range(1, 6):
        sizes = [sum(r["label"] == label and r["fold"] == f for r in got) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    split = folds.stratified_split(df).collect()
    for label in range(1, 6):
        here = [r["split"] for r in split if r["label"] == label]
        assert here.count("test") == round(0.2 * len(here))


def test_duplicates(rows):
    counts = {k: KEYS.count(k) for k in set(KEYS)}
    assert profile.dup_count(rows, ["key"]).first()[0] == sum(n - 1 for n in counts.values())
    long = rows.select(F.concat(F.repeat(F.lit("x"), 500), F.coalesce("key", F.lit("-"))).alias("t"))
    assert profile.dup_count(long).first()[0] == len(KEYS) - len(counts)
    got = profile.dup_rows(rows.where("key is not null"), "key").count()
    assert got == sum(n for k, n in counts.items() if k and n > 1)


def test_author_stats_with_a_hot_name(spark):
    authors = ["Hot Name, A%d" % (i % 7) for i in range(300)] + [None, " , ", "Solo"]
    df = spark.createDataFrame(list(enumerate(authors)), "id long, authors string").repartition(4)
    lists = {i: [n.strip() for n in (a or "").split(",") if n.strip()] for i, a in enumerate(authors)}
    freq: dict[str, int] = {}
    for names in lists.values():
        for n in names:
            freq[n] = freq.get(n, 0) + 1
    for r in metadata.author_stats(df, metadata.author_frequency(df)).collect():
        f = [freq[n] for n in lists[r["id"]]] or [0]
        expected = (len(lists[r["id"]]), np.mean(f), max(f), min(f))
        assert tuple(r)[1:] == pytest.approx(expected)


def test_unseen_venue_and_author(spark):
    train = spark.createDataFrame(
        [(1, "b", "2000", "X, Y", "t"), (2, None, "2030", "X", ""), (3, "a", "bad", "", None)],
        "id long, venue string, year string, authors string, abstract string")
    test = spark.createDataFrame(
        [(9, "zzz", "2015", "X, New", "  ")], train.schema)
    raw = metadata.raw_metadata(test, metadata.venue_index(train), metadata.author_frequency(train)).first()
    assert raw.asDict() == {
        "id": 9, "venue_encoded": -1.0, "year_norm": 0.5, "author_count": 2.0, "author_freq_mean": 1.0,
        "author_freq_max": 2.0, "author_freq_min": 0.0, "has_abstract": 0.0, "has_authors": 1.0,
    }
    scaled = metadata.metadata_features(train, metadata.fit_metadata(train)).collect()
    for c in metadata.SCALED:
        column = np.array([r[c] for r in scaled])
        assert column.mean() == pytest.approx(0, abs=1e-9)
        assert column.std() == pytest.approx(1)


@pytest.mark.parametrize("limit", [None, 50])
def test_tfidf_norms(spark, limit):
    docs = [(i, "common words here " + " ".join(f"t{(i * j) % 23}x" for j in range(i % 9))) for i in range(120)]
    docs += [(500, ""), (501, None)]
    df = spark.createDataFrame(docs, "id long, t string").repartition(3)
    got = terms.tfidf(df, "t", max_features=limit).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert len(got) == 120
    assert all(r["s"] == pytest.approx(1.0) for r in got)


# --- nearest neighbours -------------------------------------------------------------------


def brute(queries, reference, k):
    out = {}
    for qid, q in queries:
        found = []
        for rid, r in reference:
            n = np.linalg.norm(q) * np.linalg.norm(r)
            found.append((round(1 - float(np.dot(q, r) / n), 9) if n else 1.0, rid))
        out[qid] = sorted(found)[:k]
    return out


@pytest.mark.parametrize("pivots, block", [(1, 4096), (7, 16), (32, 5)])
def test_knn_equals_brute_force(spark, pivots, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    reference = [(i, centres[i % 6] + rng.normal(scale=0.2, size=8)) for i in range(150)]
    reference += [(200 + i, centres[0]) for i in range(80)]  # a mass of copies
    reference += [(400, np.zeros(8)), (401, np.zeros(8))]
    queries = [(1000 + i, centres[i % 6] + rng.normal(scale=0.3, size=8)) for i in range(40)]
    queries += [(2000, centres[0]), (2001, np.zeros(8)), (2002, -centres[1])]
    frame = lambda rows: spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in rows], "id long, embedding array<double>").repartition(3)
    got: dict[int, list] = {}
    for r in knn.knn_join(frame(queries), frame(reference), 5, pivots, block).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["distance"], r["neighbour_id"]))
    expected = brute(queries, reference, 5)
    assert set(got) == set(expected)
    for qid, near in expected.items():
        assert [i for _, _, i in sorted(got[qid])] == [i for _, i in near], qid
        assert [d for _, d, _ in sorted(got[qid])] == pytest.approx([d for d, _ in near], abs=2e-9)


def test_knn_with_few_references(spark):
    schema = "id long, embedding array<double>"
    reference = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema)
    queries = spark.createDataFrame([(5, [1.0, 0.1])], schema)
    assert [r["neighbour_id"] for r in knn.knn_join(queries, reference).orderBy("rank").collect()] == [1, 2]
    assert knn.knn_join(queries, reference.where("id > 5")).count() == 0


def test_vote(spark):
    near = spark.createDataFrame(
        [(1, 10, 0.0), (1, 11, 0.1), (1, 12, 0.1), (2, 11, 0.5), (2, 10, 0.5), (3, 11, 0.2), (3, 12, 0.3), (3, 10, 0.15)],
        "id long, neighbour_id long, distance double")
    labels = spark.createDataFrame([(10, 4), (11, 2), (12, 2)], "id long, label int")
    got = {r["id"]: r["prediction"] for r in knn.knn_vote(near, labels).collect()}
    assert got == {1: 4, 2: 2, 3: 2}
