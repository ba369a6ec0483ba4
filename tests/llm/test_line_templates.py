from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from conftest import SMALL

from paperloom.llm import line_templates as lt
from paperloom.llm.queries import QUERIES


def brute(texts, depth=lt.DEPTH, least=lt.MIN_DOCS, constant=lt.CONSTANT):
    """The lines to drop (as tuples of masked words), by counting over all different texts."""
    def masked(line):
        return tuple(b"<*>" if any(chr(c).isdigit() and c < 128 for c in w) else w for w in line.encode().split())

    docs = defaultdict(set)
    for t in set(texts):
        for line in (t or "").split("\n"):
            if masked(line):
                docs[masked(line)].add(t)
    def enough(words):
        return lt.LONG_DOCS if len(words) > lt.LONG_WORDS else least

    drop = {w for w, d in docs.items() if len(d) >= enough(w)}
    leaves = defaultdict(list)
    for w in docs:
        leaves[len(w), w[:depth]].append(w)
    shapes, members = defaultdict(set), defaultdict(list)
    for lines in leaves.values():
        if len(lines) < 2:
            continue
        count = Counter((k, x) for w in lines for k, x in enumerate(w) for _ in docs[w])
        for w in lines:
            if len(w) <= depth:
                continue
            stays = [k < depth or count[k, x] >= enough(w) for k, x in enumerate(w)]
            if sum(stays) >= constant * len(w):
                shape = (len(w), w[:depth], tuple(x if s else None for x, s in zip(w, stays)))
                shapes[shape] |= docs[w]
                members[shape].append(w)
    return drop | {w for s, d in shapes.items() if len(d) >= enough(members[s][0]) for w in members[s]}, masked


LICENSE = "Released under the terms of the {} license by its authors"
NAMES = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
TEXTS = [f"own words of text {i} {'abcdefghij'[i % 10]}{NAMES[i % 6]}\nPage {i} of 99\n" + LICENSE.format(NAMES[i]) for i in range(6)]
TEXTS += ["copied header line\nbody\n"] * 9  # one text, nine copies
TEXTS += [None, "", "\n \n\t", "A b c d e f\r\nrest", "x " * 60_000, "only here\nPage 7 of 99", "A b c zz yy xx"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 3 else i, t, 1, "d", "w") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, line int, drop string, whole string").repartition(3)


def check(rows, texts):
    drop, masked = brute(texts)
    for text, got, n_lines, n_dropped in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if masked(x) not in drop]
        assert got == (None if text is None else "\n".join(kept))
        assert n_lines == sum(bool(masked(x)) for x in lines) and n_dropped == len(lines) - len(kept)
    return drop


def test_odd_texts(docs):
    out = lt.without_recurring(docs)
    assert out.columns == ["row", "n_lines", "n_dropped"] and out.select("row.*").columns == docs.columns
    by_id = dict(enumerate(TEXTS))
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    found = [(by_id[3 if r["row"]["doc_id"] is None else r["row"]["doc_id"]], r["row"]["text"], r["n_lines"], r["n_dropped"]) for r in rows]
    drop = check(found, TEXTS)
    assert any(b"license" in w for w in drop) and (b"Page", b"<*>", b"of", b"<*>") in drop
    assert (b"copied", b"header", b"line") not in drop


def test_empty_table(docs):
    assert lt.without_recurring(docs.limit(0)).collect() == []


def test_whole_table(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op4_line_templates"].run(spark, SMALL).collect()
    assert len(rows) == len(texts)
    check([(texts[r["doc_id"]], r["text_kept"], r["n_lines"], r["n_dropped"]) for r in rows], list(texts.values()))


def passage(name, words):
    return " ".join(f"{name}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}" for i in range(words))


def test_long_passages_in_few_documents_go(spark):
    own = [f"{x} has a line of its own" for x in NAMES]
    lines = [[x] for x in own]
    for name, n in (("two", 2), ("three", 3), ("four", 4)):
        for i in range(n):
            lines[i].append(passage(name, lt.LONG_WORDS + 1))
            lines[i].append(passage("short" + name, lt.LONG_WORDS))  # too short for so few documents
    lines[5].append(passage("once", 80))
    near = passage("near", 60).split()
    for i in (0, 1):  # a long template with a variable field, in two documents
        lines[i].append(" ".join([*near[:30], NAMES[i], *near[31:]]))
    texts = ["\n".join(x) for x in lines]
    texts += [passage("copies", 70)] * 4  # one text, four copies
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    gone = [passage(name, lt.LONG_WORDS + 1) for name in ("two", "three", "four")]
    for r in lt.without_recurring(docs).collect():
        kept = [x for x in texts[r["row"]["doc_id"]].split("\n") if x not in gone and not x.startswith("neara")]
        assert r["row"]["text"] == "\n".join(kept)


def test_a_hot_line_and_a_hot_text(spark):
    texts = [f"hot line of all\n{NAMES[i % 6]} number {'abcdefghij'[i % 10]}{'abcdefghij'[i // 10 % 10]} own" for i in range(90)]
    texts += ["hot text of its own\nhot line of all"] * 60 + [None] * 20 + [" "] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = lt.without_recurring(docs).collect()
    assert len(rows) == len(texts)
    check([(texts[r["row"]["doc_id"]], r["row"]["text"], r["n_lines"], r["n_dropped"]) for r in rows], texts)
