from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import SMALL

from paperloom.llm import decontaminate as d
from paperloom.llm.common import folded
from paperloom.llm.queries import QUERIES


def distance(p, t):
    """Edits of the cheapest place of the whole of ``p`` in ``t``."""
    row = [0] * (len(t) + 1)
    for c in p:
        new = [row[0] + 1]
        for j, x in enumerate(t):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(1500):
        p = [rng.randrange(3) for _ in range(rng.randrange(1, 9))]
        t = [rng.randrange(3) for _ in range(rng.randrange(0, 14))]
        k = rng.randrange(0, 4)
        got = d.aligned(np.array(p), np.array(t, int), -len(p) - 2, len(p) + len(t) + 5, k)
        best = distance(p, t)
        assert (got is None) == (best > k)
        if got:
            assert got[2] == best == distance(p, t[got[0]:got[1]])


def brute(text, item):
    """Whether some window of the item lies in the text with few enough edits, by full tables."""
    chars, _ = folded(text or "")
    goal, _ = folded(item)
    return any(distance(goal[s:s + n].tolist(), chars.tolist()) <= k for s, n, k in d.cut(len(goal), d.Q, d.WINDOW, d.RATE))


def test_no_window_within_the_budget_is_lost():
    rng = random.Random(2)
    words = ["the", "and", "of", "tion", "ing", "her", "ere", "ent"]
    item = " ".join(rng.choice(words) + rng.choice(words) for _ in range(24))
    index = d.Index.build([(1, item)], d.Q, d.WINDOW, d.RATE)
    seen = set()
    for _ in range(60):
        part = list(item[rng.randrange(0, 20):])
        for _ in range(rng.randrange(0, 22)):
            at = rng.randrange(len(part))
            part[at:at + 1] = rng.choice([[], ["q"], [part[at], "z"]])
        text = " ".join(rng.choice(words) for _ in range(30)) + " " + "".join(part) + " end of it"
        found = bool(index.search(text))
        assert found == brute(text, item)
        seen.add(found)
    assert seen == {True, False}


ITEM = "Which of these rivers flows through the largest number of countries on its way from the source to the sea? The answer is the Danube."
ROWS = [
    (1, "Intro text. " + ITEM + " More text."), (2, ITEM.upper().replace(" ", "\n  ")), (3, None), (4, ""), (5, "!!! ???"),
    (6, "clean words only " * 40), (7, "long " * 50_000 + ITEM + " tail" * 20_000), (1, "Intro text. " + ITEM + " More text."),
    (None, ITEM[20:]), (8, ITEM[:60]), (9, "it says pi day"), (10, "a tip: dayly"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "m", 1, "r") for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, matches string, start long, row string").repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, ITEM, 0), (2, None, 0), (3, "", 0), (4, "...", 0), (5, "Pi day", 0), (None, ITEM, 0)]
    return spark.createDataFrame(rows, "item_id long, text string, matches int")


@pytest.mark.parametrize("block_chars", [d.BLOCK_CHARS, 60])
def test_odd_rows(docs, bench, block_chars):
    found = {(r["row"]["doc_id"], r["row"]["text"]): r["matches"] for r in d.find_passages(docs, bench, block_chars=block_chars).collect()}
    for (i, text), matches in found.items():
        items = {m["item_id"] for m in matches}
        assert items == ({1, None} if i in (1, 2, 7, None) else {5} if i == 9 else set()), i
        for m in matches:
            assert m["edits"] == 0
            if i in (1, 7):
                assert text[m["start"]:m["stop"]] == ITEM[:-1]
            if i == 9:
                assert text[m["start"]:m["stop"]] == "pi day"


def test_filter_keeps_clean_rows_whole(docs, bench):
    kept = d.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 8, 10]
    assert d.decontaminated(docs, bench.limit(0)).count() == len(ROWS)
    assert d.decontaminated(docs.limit(0), bench).collect() == []


def test_whole_table(spark):
    rows = QUERIES["op5_decontamination"].run(spark, SMALL).collect()
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    items = dict(spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect())
    plain = lambda t: bytes(folded(t)[0].astype("<u4"))
    whole = {i: {k for k, t in items.items() if plain(t) in plain(texts[i])} for i in texts}
    assert sum(map(bool, whole.values())) > 0
    for r in rows:
        assert whole[r["doc_id"]] <= set(r["items"]) and r["contaminated"] == bool(r["items"])
        for m in r["matches"]:
            assert brute(texts[r["doc_id"]][m["start"]:m["stop"]], items[m["item_id"]])


def test_every_partial_copy_of_the_stated_length_is_found(spark):
    path = "/root/testdata/sf0.001/benchmark.parquet"
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(path).orderBy("item_id").limit(6).collect()]
    index = d.Index.build(items, d.Q, d.WINDOW, d.RATE)
    clean = "plain words that no item of any benchmark holds stand before and after the copied part "
    assert index.search(clean * 2) == []
    for item_id, text in items:
        chars = d.as_text(folded(text)[0])
        for at in range(len(chars) - d.RUN + 1):
            found = index.search(clean + "| " + chars[at:at + d.RUN] + " | " + clean)
            assert item_id in [f[0] for f in found], (item_id, at)
