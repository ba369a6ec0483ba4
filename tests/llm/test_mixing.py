from __future__ import annotations

from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paperloom.llm import mixing
from paperloom.llm.queries import QUERIES


def size(text):
    return len((text or "").encode().split())


def highest_quotients(shares, seats):
    given_ = [0] * len(shares)
    for _ in range(seats if sum(shares) else 0):
        best = max(range(len(shares)), key=lambda i: (Fraction(shares[i], 2 * given_[i] + 1), -i))
        given_[best] += 1
    return given_


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9), st.integers(0, 60))
def test_apportionment_equals_highest_quotients(shares, seats):
    assert mixing.apportion(shares, seats) == highest_quotients(shares, seats)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=9))
def test_targets_share_all_and_stop_at_three_times(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    out = mixing.targets(sizes, weights)
    assert abs(sum(out) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(t <= 3 * s + 1e-9 for t, s in zip(out, sizes))
    free = [t / w for t, w, s in zip(out, weights, sizes) if s and t < 3 * s - 1e-9]
    assert not free or max(free) - min(free) < 1e-6 * max(free)
    assert all(3 * s <= max(free) * w + 1e-6 for t, w, s in zip(out, weights, sizes) if free and s and t >= 3 * s - 1e-9)


def test_shard_quotas_equal_highest_quotients(spark):
    words = [400, 390, 20, 5, 333, 1, 800]
    for blocks in (0, 3, 17, 60, 181):
        rows = [(0, k, sum(words), blocks, w) for k, w in enumerate(words)]
        cells = spark.createDataFrame(rows, "source_no int, shard long, source_size long, blocks long, words long")
        got = {r["shard"]: r["quota"] for r in mixing.shard_quotas(cells).collect()}
        assert [got[k] for k in range(len(words))] == highest_quotients(words, blocks)


def test_ranges_take_the_quota():
    sizes = np.array([5, 70, 1, 200, 33])
    for quota in (0, 1, 5, 9, 10, 11, 25, 30, 99):
        rounds, ranges = mixing.taken_ranges(sizes, quota, 3, 32)
        taken = [s * rounds + sum(b - a for a, b in r) for s, r in zip(sizes, ranges)]
        assert all(0 <= a < b <= s for s, r in zip(sizes, ranges) for a, b in r)
        assert all(t <= 3 * s for t, s in zip(taken, sizes))
        assert abs(sum(taken) - min(quota * 32, 3 * 309)) <= 32  # a block


ROWS = (
    [(i, f"text {i} " + "word " * (i % 50), "b" if i % 3 else "a", "t") for i in range(300)]
    + [(None, "same row of words", None, "t")] * 40 + [(7, "equal row", "b", "t")] * 30
    + [(1000, None, "a", "t"), (1001, "", "zero", "t"), (1002, " \n ", "zero", "t"), (1003, "big " * 20_000, "é", None)]
)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string, taken string").repartition(4)


def by_source(rows):
    taken, target = Counter(), {}
    for source, t, goal in rows:
        taken[source] += t
        target[source] = goal
    return taken, target


def test_odd_rows(docs):
    plan = mixing.mix_plan(docs).collect()
    assert Counter((r["id"], r["size"]) for r in plan) == Counter((i, size(t)) for i, t, _, _ in ROWS)
    sizes = Counter()
    for _, t, s, _ in ROWS:
        sizes[s] += size(t)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, mixing.targets([sizes[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))])))
    taken = Counter()
    source_of = {(i, size(t)): s for i, t, s, _ in ROWS}
    for r in plan:
        source = source_of[r["id"], r["size"]]
        assert r["source_size"] == sizes[source] and abs(r["target"] - goal[source]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 2 * mixing.BLOCK for s in names)


def test_the_mix_holds_what_was_planned(docs):
    plan = Counter()
    for r in mixing.mix_plan(docs).collect():
        plan[r["id"]] += r["taken"]
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    got = Counter()
    texts = {i: t for i, t, _, _ in ROWS}
    for r in rows:
        got[r["doc_id"]] += size(r["text"])
        words = (texts[r["doc_id"]] or "").split()
        assert len(words) > 1000 or not set(r["text"].split()) - set(words) or r["doc_id"] == 7
    total = sum(plan.values())
    assert abs(sum(got.values()) - total) <= 8 * mixing.BLOCK
    assert sorted(map(tuple, mixing.mixed(docs).collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_cut_words_keeps_the_space_between():
    text = "  one two\n three  four é five "
    assert mixing.cut_words([text, None, ""], [[{"start": 1, "stop": 4}, {"start": 5, "stop": 6}], [], []]) == [
        "two\n three  four five", "", ""]


def test_empty_table(docs):
    assert mixing.mix_plan(docs.limit(0)).collect() == [] and mixing.mixed(docs.limit(0)).collect() == []


def test_whole_table(spark):
    rows = QUERIES["op6_mixing"].run(spark, SMALL).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["size"] == size(docs[r["doc_id"]]["text"]) and r["taken"] <= 3 * r["size"] for r in rows)
    taken, target = by_source((docs[r["doc_id"]]["source"], r["taken"], r["target"]) for r in rows)
    assert all(abs(taken[s] - target[s]) <= 3 * mixing.BLOCK for s in target)
    again = QUERIES["op6_mixing"].run(spark, SMALL)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))
