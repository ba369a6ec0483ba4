from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from paperloom.llm import jaccard
from paperloom.llm.components import components
from paperloom.llm.queries import QUERIES


def shingle_set(text):
    words = [w for w in (text or "").encode().split()]
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute(rows):
    """For each row (id, text): class id, copy id and links, by comparing all different texts."""
    ids, sets = defaultdict(list), {}
    for i, text in rows:
        words = tuple((text or "").encode().split())
        if words:
            ids[words].append(i)
            sets[words] = shingle_set(text)
    keys = list(sets)
    parent, links = {k: k for k in keys}, Counter()
    for a in range(len(keys)):
        for b in range(a):
            x, y = sets[keys[a]], sets[keys[b]]
            both = len(x & y)
            if both >= 0.8 * (len(x) + len(y) - both):
                links[keys[a]] += 1
                links[keys[b]] += 1
                parent[find(parent, keys[a])] = find(parent, keys[b])
    least = lambda values: min((v for v in values if v is not None), default=None)
    groups = defaultdict(list)
    for k in keys:
        groups[find(parent, k)] += ids[k]
    out = []
    for i, text in rows:
        words = tuple((text or "").encode().split())
        if words:
            out.append((i, least(groups[find(parent, words)]), least(ids[words]), links[words]))
        else:
            out.append((i, i, i, 0))
    return out


def order(rows):
    return sorted(rows, key=repr)


def near_texts():
    rng = random.Random(5)
    rows, n = [], 0
    for size in (3, 30, 90):
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(12):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
            rows.append((n, " ".join(words)))
            n += 1
    return rows


ODD = near_texts() + [
    (None, "no id here at all"), (None, "no id here at all"), (900, None), (901, ""), (902, " \n\t "), (903, "one"),
    (904, "one"), (904, "one"), (905, "a b c d e"), (906, "a  b\nc d\te"), (907, "word " * 30_000),
    (908, "word " * 30_001), (909, "é ü ñ ß"), (909, "é ü ñ ß x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "k", 1, "r") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, whole long, row string").repartition(3)


def test_odd_rows_against_brute_force(odd):
    got = [tuple(r) for r in jaccard.members(odd).select("id", "class_id", "copy_id", "n_links").collect()]
    assert order(got) == order(brute(ODD))


def test_small_blocks_give_the_same(odd, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 3)
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", 900)
    got = [tuple(r) for r in jaccard.members(odd).select("id", "class_id", "copy_id", "n_links").collect()]
    assert order(got) == order(brute(ODD))


def test_one_of_each_group_stays(odd):
    kept = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(odd).collect()]
    assert jaccard.one_of_each(odd).columns == odd.columns
    classes = brute(ODD)
    worded = {c for (_, t), (_, c, _, _) in zip(ODD, classes) if (t or "").split() and c is not None}
    assert {i for i, t in kept if (t or "").split() and i is not None} == worded
    assert sum(i is None for i, _ in kept) == 1
    assert {i for i, t in kept if not (t or "").split()} == {900, 901, 902}
    assert len(kept) == len(worded) + 5  # two different texts have id 909


def test_empty_table(odd):
    assert jaccard.members(odd.limit(0)).collect() == [] and jaccard.one_of_each(odd.limit(0)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = [(r["doc_id"], r["class_id"], r["copy_id"], r["n_links"]) for r in QUERIES["op9_ngram_jaccard"].run(spark, SMALL).collect()]
    assert order(got) == order(brute([tuple(r) for r in docs]))


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    lost = 0
    for _ in range(300):
        common = rng.integers(0, 1 << 62, 80, dtype=np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 1 << 62, 10, dtype=np.uint64)]) for _ in range(2))
        sigs = [jaccard.signature(x)[None] for x in (a, b)]
        lost += not len(jaccard.surviving(*sigs, np.ones((1, 1), bool)))
    assert lost == 0
    far = [jaccard.signature(rng.integers(0, 1 << 62, 90, dtype=np.uint64))[None] for _ in range(2)]
    assert not len(jaccard.surviving(*far, np.ones((1, 1), bool)))


def test_both_ways_of_exact_counting_agree():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
    sets = {i: np.unique(np.concatenate([base[:rng.integers(40, 60)], rng.integers(0, 1 << 62, 5, dtype=np.uint64)])) for i in range(20)}
    pairs = np.array([(i, j) for i in range(20) for j in range(i)])
    many = {tuple(p) for p in jaccard.exact(pairs, sets, sets).tolist()}
    few = {tuple(p) for k in range(0, len(pairs), 10) for p in jaccard.exact(pairs[k:k + 10], sets, sets).tolist()}
    assert many == few and 0 < len(many) < len(pairs)


def test_components_of_chains_stars_and_odd_edges(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(510, 560)] + [(7, 7), (None, 3), (9, None), (-5, 8), (8, -5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in [500, *range(510, 560)]} | {-5: -5, 8: -5}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
