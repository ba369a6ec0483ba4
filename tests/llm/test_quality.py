from __future__ import annotations

import re
from collections import Counter

import pytest
from conftest import SMALL

from paperloom.llm import quality
from paperloom.llm.queries import QUERIES

ODD = [
    (1, None), (2, ""), (3, " \n\t\x0b"), (4, "a b c d e f g h i j"), (5, "one two three four five " * 5 + "six seven eight"),
    (6, "same line\nsame line\nother\n\n\nsame line"), (7, "x\x1cy\xa0z é ü 😀 words here and more of them to see"),
    (8, "word " * 100_000), (9, "w### a$$$ b%%% c&&& d| e< f> g* h# i$"), (10, "NO! WAY! THIS! IS! LOUD! AND! MORE! LOUD! STILL! YES!"),
    (None, "a b c d e f g h i j"), (4, "a b c d e f g h i j"),
]


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            again.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again))


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "q", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, q string, n_words int").repartition(3)


def test_measures_of_odd_texts(odd):
    for r in quality.cascade(odd, quality.RULES, measures=True).collect():
        q = r["q"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == plain(r["row"]["text"])


def test_order_changes_no_verdict(odd):
    want = {i: [r.name for r in quality.RULES if r.rejects(quality.Measures(t))] for i, t in ODD}
    for rules in (quality.RULES, quality.RULES[::-1], quality.ordered_rules(odd)):
        assert set(rules) == set(quality.RULES)
        for r in quality.cascade(odd, rules).collect():
            names = want[r["row"]["doc_id"]]
            assert r["q"]["rejected_by"] == next((x.name for x in rules if x.name in names), None)


def test_rules_are_ordered_by_rejections_per_cost(spark):
    docs = spark.createDataFrame([(i, "abc " * 20) for i in range(50)], "doc_id long, text string")

    def slow(m):
        return sum(range(200_000)) > 0

    rules = (quality.Rule("never", lambda m: False), quality.Rule("slow", slow), quality.Rule("quick", lambda m: True))
    assert [r.name for r in quality.ordered_rules(docs, rules)] == ["quick", "slow", "never"]


def test_kept_rows_and_empty_table(odd):
    kept = quality.kept(odd)
    assert kept.columns == odd.columns
    assert [r["doc_id"] for r in kept.collect()] == [7]
    assert quality.kept(odd.limit(0)).collect() == []


def test_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    quality_of = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = QUERIES["op2_quality_rules"].run(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        n, *rest = plain(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, *rest)
        assert r["base_failed"] == (n < 10 or 100 * rest[3] > 20 * n)
        assert not (r["base_failed"] and r["kept"])
        if quality_of.get(r["doc_id"]) == 1 and not r["base_failed"]:
            assert r["kept"]
        if quality_of.get(r["doc_id"]) == 0:
            assert not r["kept"]
