"""The fitted operators: languages and toxicity."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from paperloom.llm import langid, toxicity
from paperloom.llm.common import sampled_texts
from paperloom.llm.queries import QUERIES

MIDDLE = SMALL.replace("0.001", "0.01")
ODD = [(1, None), (2, ""), (3, "123 !!! \n"), (4, "le la les " * 40_000), (None, "the and of"), (5, "é"), (5, "é")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "fr", "x", 1.0) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double").repartition(2)


def test_languages_on_held_out_rows(spark):
    rows = QUERIES["op1_language_id"].run(spark, MIDDLE).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    import zlib

    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.98 * len(held)


def test_language_of_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(docs, F.lit(True))
    assert langid.identify(odd, model).columns == ["row", "lang_pred", "score"]
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == (langid.UNKNOWN, 0.0)
    assert got[4][0] in ("fr", "es") and 0 <= got[4][1] <= 1
    nothing = langid.train(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(odd, nothing).collect()} == {langid.UNKNOWN}
    one = langid.train(docs.where("lang = 'fr'"), F.lit(True))
    assert {r["lang_pred"]: r["score"] for r in langid.identify(odd, one).collect()} == {"fr": 1.0, langid.UNKNOWN: 0.0}


def test_family_comes_first(spark):
    rows = [(i, f"aaa bbb {'xy' * (i % 7)} ccc", "en") for i in range(60)] + [(i, f"ddd eee {'xy' * (i % 7)}", "de") for i in range(60)]
    rows += [(i, f"mmm nnn {'xy' * (i % 7)} ooo", "fr") for i in range(60)] + [(i, "qqq rrr sss", "xx") for i in range(60)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert model.families == ["germanic", "romance", "xx"] and model.pairs["romance"] == []
    assert len(model.pairs["germanic"]) == 1
    assert [x for x, _ in model.predict(["aaa ccc", "ddd ddd", "mmm nnn", "rrr sss qqq"])] == ["en", "de", "fr", "xx"]


@pytest.mark.parametrize("more", [["es"], ["de", "es"]])
def test_languages_of_copies_are_learned(spark, more):
    words = {"en": "the cat sat on the mat", "zz": "qua qui quo quux", "de": "der hund und die katze", "es": "el perro y la casa"}
    copied = ["en", "zz"] if len(more) == 1 else ["en"]
    rows = [(words[x], x) for x in copied for _ in range(4000)] + [(f"{words[x]} {'abcdefg'[i % 7] * (i % 9)}", x) for x in more for i in range(100)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    model = langid.train(docs, F.lit(True))
    assert sorted(x for m in model.members.values() for x in m) == sorted(copied + more)
    assert [x for x, _ in model.predict([words[x] for x in copied + more])] == copied + more


def test_samples_count_texts_not_copies(spark):
    rows = [("hot", "a")] * 3000 + [(f"text {i}", "a") for i in range(3000)] + [("one", "b")]
    df = spark.createDataFrame(rows, "text string, kind string").repartition(4)
    got = sampled_texts(df, 100).collect()
    kinds = [r["kind"] for r in got]
    assert len(set(got)) == len(got) and kinds.count("b") == 1 and 60 <= kinds.count("a") <= 140
    assert len(sampled_texts(df.select("text"), 10_000).collect()) == 3002
    assert sampled_texts(df.limit(0), 10).collect() == []


def test_predictions_equal_plain_python(spark):
    """The model's own rule in dictionaries: every row of a whole table."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(docs, F.lit(True))
    for r in langid.identify(docs, model).collect():
        text = r["row"]["text"] or ""
        plain = "".join(c if c.isalpha() else " " for c in text)
        plain = "".join(c.lower()[0] for c in plain)
        plain = " ".join(plain.split(" ")).strip()
        while "  " in plain:
            plain = plain.replace("  ", " ")
        if not plain:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        padded = f" {plain} "
        grams = [padded[k:k + n] for n in (1, 2, 3) for k in range(len(padded) - n + 1)]
        count = {}
        for g in grams:
            code = 0
            for k, c in enumerate(g):
                code = ord(c) if k == 0 else (code * 65_599 + ord(c)) % 2**64
            code = (code + len(g)) * 0x9E3779B97F4A7C15 % 2**64
            number = (code >> 40) % langid.DIMENSIONS
            count[number] = count.get(number, 0) + 1
        score = [sum(n * langid.SCALE / len(grams) * model.weights[k, c] for k, n in count.items()) + model.bias[c] for c in range(len(model.bias))]
        family = model.families[max(range(len(model.families)), key=lambda f: score[f])]
        wins = Counter()
        for column, a, b in model.pairs[family]:
            wins[a if score[column] >= 0 else b] += 1
        members = model.members[family]
        best = max(wins.values(), default=0)
        assert members.index(r["lang_pred"]) in [i for i in range(len(members)) if wins[i] == best]


def test_toxic_labels_on_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.where("doc_id % 2 = 0"), F.col("toxic"))
    scored = toxicity.severity(docs, model).select("row.doc_id", "severity", "grade").join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = scored.collect()
    toxic, clean = ([r for r in rows if r["toxic"] == t] for t in (1, 0))
    assert sum(r["grade"] > 0 for r in toxic) >= 0.88 * len(toxic)  # some labels are noise
    assert sum(r["grade"] > 0 for r in clean) <= 0.005 * len(clean)
    assert np.mean([r["severity"] for r in toxic]) > 1 > np.mean([r["severity"] for r in clean])


def test_severities_equal_plain_python(spark):
    """Every row of a whole table, from the weights alone."""
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels, F.col("toxic"))
    assert model.weights and model.cuts == sorted(model.cuts)
    for r in toxicity.severity(docs, model).collect():
        words = set("".join(c if c.isalpha() else " " for c in (r["row"]["text"] or "").lower()).split(" ")) - {""}
        held = words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}
        score = sum(model.weights.get(x, 0.0) for x in held)
        chances = [1 / (1 + np.exp(c - score)) for c in model.cuts]
        assert r["severity"] == pytest.approx(sum(chances), abs=1e-9) and r["p_toxic"] == pytest.approx(chances[0], abs=1e-9)
        assert r["grade"] == sum(p >= 0.5 for p in chances)


def test_severity_of_odd_rows(spark, odd):
    model = toxicity.Model({"le": 2.0, "the": 5.0}, [1.0, 3.0])
    got = {r["row"]["doc_id"]: r for r in toxicity.severity(odd, model).collect()}
    least = sum(1 / (1 + np.exp(c)) for c in (1.0, 3.0))
    assert all(abs(got[i]["severity"] - least) < 1e-12 and got[i]["grade"] == 0 for i in (1, 2, 3, 5))
    assert got[4]["grade"] == 1 and got[None]["grade"] == 2 and got[None]["severity"] > got[4]["severity"]
    kept = toxicity.without_toxic(odd, model)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5, 5]
    assert toxicity.severity(odd.limit(0), model).collect() == []


def test_training_without_grades(spark, odd):
    labels = spark.createDataFrame([(1, None), (4, 0)], "doc_id long, toxic int")
    for marks in (labels.limit(0), labels):
        model = toxicity.train(odd, marks, F.col("toxic"))
        assert {r["severity"] for r in toxicity.severity(odd, model).collect()} == {0.0}


def test_cumulative_fit_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 400)
    rows = [sorted({0} & {0} if g == 0 else set(range(1, g + 1))) for g in grades]
    weights, cuts = toxicity.fit_cumulative(rows, grades, 4)
    assert (np.diff(cuts) > 0).all() and (weights >= 0).all()
    score = [weights[r].sum() for r in ([0], [1], [1, 2], [1, 2, 3])]
    assert [sum(s > cuts) for s in score] == [0, 1, 2, 3]
