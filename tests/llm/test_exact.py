from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from paperloom.llm import exact
from paperloom.llm.queries import QUERIES

TEXTS = [(1, "Same Text"), (2, "same text"), (7, "SAME TEXT"), (3, "Ünlike"), (4, "ünlike"), (5, None), (6, ""),
         (None, "no id"), (None, "No id"), (8, "no id"), (9, "x" * 300_000), (10, "X" * 300_000), (11, "twice"), (11, "twice"),
         (None, "alone"), (12, "K"), (13, "k"), (14, " k"), (15, "a\0"), (16, "a")]


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "k", True, b"s") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, nr int, key string, kept boolean, sha binary").repartition(3)


def expected(rows):
    members = defaultdict(list)
    for i, t in rows:
        members[normal(t)].append(i)
    out = []
    for t, ids in members.items():
        last = max(ids, key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)):
            out.append((i, last, len(ids), k == 0, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def shown(found):
    return sorted([(r["id"], r["keep_id"], r["group_size"], r["kept"], r["sha"].hex()) for r in found.collect()], key=str)


def test_odd_rows(docs):
    assert shown(exact.groups(docs)) == expected(TEXTS)
    assert exact.groups(docs.limit(0)).collect() == []


@pytest.mark.parametrize("key", [lambda t: F.char_length(t) % 3, lambda t: F.lit(0)])
def test_colliding_hashes_keep_texts_apart(docs, key):
    assert not exact.collisions(docs, key=key).isEmpty() and exact.collisions(docs).isEmpty()
    assert shown(exact.groups(docs, key=key)) == expected(TEXTS)


def test_rows_that_stay(docs):
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    want = sorted([(i, h) for i, _, _, k, h in expected(TEXTS) if k], key=str)
    got = [(r["doc_id"], hashlib.sha256(normal(r["text"]).encode()).hexdigest()) for r in kept.collect()]
    assert sorted(got, key=str) == want
    assert exact.deduplicated(docs.limit(0)).collect() == []


def test_a_hot_group_is_neither_lost_nor_doubled(spark):
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("Own "), "id")).otherwise("Hot").alias("text"))
    got = exact.groups(docs).groupBy("kept").agg(F.count("*").alias("n"), F.max("group_size").alias("most")).collect()
    assert {r["kept"]: (r["n"], r["most"]) for r in got} == {True: (6_001, 3_000), False: (2_999, 3_000)}


def test_no_python_and_no_wide_broadcast(docs):
    plan = exact.groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op13_exact_dedup"].run(spark, SMALL).collect()]
    assert sorted(got, key=str) == expected(rows)
