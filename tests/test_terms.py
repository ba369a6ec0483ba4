"""Terms counted by fixed-width marks and keywords from the terms that can be among the best."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.operators import terms

STOP = ["the"]


@pytest.fixture(scope="module")
def records():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    shares = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, shares, k=rng.randrange(1, 40))) for _ in range(150)]
    texts += ["", None, "the", "rare1 rare1 rare2 rare2 w0 w1", "alone " * 30, texts[3], texts[3]]
    rows = list(enumerate(texts))
    # An id that comes twice, and terms that only a record without id has.
    return [*rows, (4, "w2 w5 twice again"), (None, "lost w9 w9 lost"), (None, None)]


@pytest.fixture(scope="module")
def frame(spark, records):
    return spark.createDataFrame(records, "id long, text string").repartition(3)


def listed(text):
    words = [w for w in (text or "").lower().split() if w not in STOP]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def counted(records):
    df, tf = {}, {}
    for _, text in records:
        found = listed(text)
        for t in found:
            tf[t] = tf.get(t, 0) + 1
        for t in set(found):
            df[t] = df.get(t, 0) + 1
    return df, tf


def test_marks_count_records_and_occurrences(frame, records):
    df, tf = counted(records)
    rows = terms.counted_marks(frame, "text", T.analyze("text", STOP)).collect()
    assert sorted((r["df"], r["tf"]) for r in rows) == sorted((df[t], tf[t]) for t in df)
    only = terms.counted_marks(frame, "text", T.analyze("text", STOP), with_tf=False).collect()
    assert sorted(r["df"] for r in only) == sorted(df.values())


@pytest.mark.parametrize("limit, min_df, max_df", [(10, 2, 0.9), (7, 1, 0.2), (40, 2, 0.9), (200, 1, 1.0), (100_000, 1, 1.0), (5, 900, 1.0)])
def test_limited_vocabulary_with_ties(frame, records, limit, min_df, max_df):
    df, tf = counted(records)
    n = len(records)
    kept = [t for t in df if min_df <= df[t] <= max_df * n]
    best = sorted(kept, key=lambda t: (-tf[t], t))[:limit]
    got = terms.limited_vocabulary(frame, "text", T.analyze("text", STOP), min_df, max_df, limit)
    assert [w for w, _ in got] == sorted(best)
    assert [x for _, x in got] == pytest.approx([math.log((1 + n) / (1 + df[t])) + 1 for t in sorted(best)])


@pytest.mark.parametrize("frequent", [1, 25, 20_000])
def test_keywords_from_the_likely_terms(spark, frame, records, monkeypatch, frequent):
    monkeypatch.setattr(terms, "FREQUENT_TERMS", frequent)
    df, _ = counted(records)
    weights: dict = {}
    for i, text in records:
        found = listed(text)
        weights.setdefault(i, []).extend(
            (-round(found.count(t) * (math.log((1 + len(records)) / (1 + df[t])) + 1), 9), t) for t in set(found))
    rows = frame.select("id", F.col("text").alias("title"), F.lit(None).cast("string").alias("abstract"))
    got = terms.topk_keywords(rows, STOP).collect()
    assert len(got) == len(records)
    for r in got:
        best = [] if r["id"] is None else [t for _, t in sorted(weights[r["id"]])[:5]]
        assert r["keywords"] == best, r["id"]


def test_only_likely_terms_are_joined(spark, monkeypatch):
    monkeypatch.setattr(terms, "FREQUENT_TERMS", 20)
    texts = [" ".join([f"k{i}x{j}" for j in range(6)] * 5 + [f"s{i}x{j}" for j in range(100)]) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    every = terms.record_terms(df, "text", STOP).count()
    likely = terms._likely(df, T.analyze("text", STOP), 5)
    assert every > 200 * 30 and likely.count() <= 12 * 30 and likely.where("raw IS NULL").isEmpty()


def test_no_terms(spark):
    none = spark.createDataFrame([(1, None), (2, "the")], "id long, text string")
    assert terms.limited_vocabulary(none, "text", T.analyze("text", STOP), 1, 1.0, 5) == []
    assert terms.tfidf(none, "text", stop_words=STOP, max_features=5).count() == 0
    rows = none.select("id", F.col("text").alias("title"), F.lit(None).cast("string").alias("abstract"))
    assert [r["keywords"] for r in terms.topk_keywords(rows, STOP).collect()] == [[], []]


def test_keywords_of_terms_that_all_differ(spark):
    texts = [" ".join(f"s{i}x{j}" for j in range(9)) for i in range(4)]
    rows = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "id long, title string, abstract string")
    got = {r["id"]: r["keywords"] for r in terms.topk_keywords(rows, STOP).collect()}
    assert got == {i: sorted(listed(t))[:5] for i, t in enumerate(texts)}


def test_terms_of_one_record_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(terms, "materialize", lambda df, name: written.append((name, df.count())) or df)
    df = spark.createDataFrame([(1, "a1 b1 c1 d1"), (2, "a1 b1 e1")], "id long, text string")
    terms._likely(df, T.analyze("text", STOP), 5)
    assert written[0] == ("terms", 3)
