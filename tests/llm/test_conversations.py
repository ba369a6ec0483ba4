from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from conftest import SMALL
from hypothesis import given, settings, strategies as st

from paperloom.llm import conversations as cv
from paperloom.llm.queries import QUERIES

MIDDLE = SMALL.replace("0.001", "0.01")
FOLLOW = {"": {"s": "s", "u": "su"}, "s": {"u": "su"}, "su": {"a": "a"}, "a": {"u": "su"}}  # state names by what was seen
SPACE = " \t\n\v\f\r"


def cheapest(rows):
    """(cost, edits, repaired rows) by dynamic programming over whole strings, least string among the cheapest."""
    best = {"": (0, "", ()), "a": (0, "", ())}
    states = ["", "s", "su", "a"]

    def inserts(level):
        for _ in states:
            for s in states:
                for initial, role in (("u", "user"), ("a", "assistant")):
                    after = level.get(FOLLOW[s].get(initial))
                    if after:
                        new = (after[0] + 5, "I" + after[1], ((role, ""), *after[2]))
                        level[s] = min(level.get(s, new), new, key=lambda x: x[:2])
        return level

    best = inserts(best)
    for role, text, fault in reversed(rows):
        level = {}
        for s in states:
            options = [(best[s][0] + 2, "D" + best[s][1], best[s][2])] if s in best else []
            if fault in (None, "truncated"):
                extra = 5 if fault else 0
                for label, cost, name in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    after = best.get(FOLLOW[s].get(name[:1]))
                    if after:
                        options.append((after[0] + cost + extra, label + after[1], ((name, text), *after[2])))
            if options:
                level[s] = min(options, key=lambda x: x[:2])
        best = inserts(level)
    return best[""]


def fault_of(role, text, seen):
    bare = text.strip(SPACE)
    fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
    seen.add((role, text))
    return fault


def expected(groups):
    """By conversation: rows of (turn, role, text) in any order."""
    out = []
    for conv, rows in groups.items():
        rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen = set()
        judged = [(r, x, fault_of(r, x, seen)) for _, r, x in rows]
        turns = {t for t, *_ in rows if t is not None}
        cost, audit, kept = cheapest(judged)
        first = [r[:1] for _, r, _ in rows]
        n = {f: sum(j[2] == f for j in judged) for f in ("blank", "duplicate", "truncated")}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=400, deadline=None, derandomize=True)
@given(st.text("suaxSUAX-", max_size=14))
def test_auction_finds_the_least_of_the_cheapest(signs):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = [("user", "", "blank") if c == "-" else (names[c.lower()], f"text {k}", "truncated" if c.isupper() else None) for k, c in enumerate(signs)]
    cost, audit, kept = cheapest(rows)
    assert cv.repaired(signs + cv.END) == (audit, cost)
    assert cv.edited([r[:2] for r in rows], audit) == list(kept)


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.text("suaxSUAX-", min_size=1, max_size=30), st.integers(1, 4))
def test_blocks_give_the_same_path(signs, size):
    pieces = [signs[at:at + size] for at in range(0, len(signs), size)]
    pieces[-1] += cv.END
    steps = cv.route([cv.signs_matrix(p) for p in pieces], 0, 3)
    audit, cost = zip(*[cv.repaired(p, s["entry"], s["exit"]) for p, s in zip(pieces, steps)])
    assert ("".join(audit), sum(cost)) == cv.repaired(signs + cv.END)


ODD = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes"), (1, 5, "user", " \t"), (1, 6, None, "Odd role."),
       (1, 7, "user", "Hi?"), (2, None, "user", "No number."), (2, None, "assistant", "None."), (None, 1, "assistant", "Alone."),
       (None, 1, "assistant", "Alone."), (3, 0, "user", None), (4, 3, "", "No role!"), (5, 1, "user", "word " * 40_000 + "."),
       (5, 1, "assistant", "Ü…"), (6, -3, "tool", "x."), (6, 9, "tool", "y."), (7, 1, "user", "Same."), (7, 2, "user", "Same.")]
ODD += [(8, t, ("user", "assistant", "tool", "system")[t * t % 5 % 4], f"Turn {t % 90}{'.' if t % 7 else ''}") for t in range(400)]
SCHEMA = "conv_id long, turn long, role string, text string, conv string, block int"


@pytest.mark.parametrize("limit, block, tasks", [(cv.LIMIT, cv.BLOCK, "4"), (5, 3, "4"), (60, 2, "7")])
def test_odd_conversations(spark, limit, block, tasks):
    docs = spark.createDataFrame([(*r, "c", 1) for r in ODD], SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        report, turns = cv.repair(docs, limit=limit, block=block)
        got = {r["conv"]: r for r in report.collect()}
        shas = {r["conv"]: r["repaired_sha256"] for r in cv.digests(turns).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    groups = defaultdict(list)
    for conv, *row in ODD:
        groups[conv].append(row)
    rows = [(c, *[r[x] for x in (*cv.REPORT, "audit")], shas[c]) for c, r in got.items()]
    assert sorted(rows, key=str) == expected(groups)


def test_empty_table_and_absent_turns(spark):
    docs = spark.createDataFrame([(1, 1, "user", "a."), (None, 2, "user", "b."), (3, 3, "user", "c.")], "conv_id long, turn long, role string, text string")
    report, turns = cv.repair(docs.limit(0))
    assert report.collect() == [] and cv.digests(turns).collect() == []
    from pyspark.sql import functions as F

    report, turns = cv.repair(docs, present=F.lit(False))
    rows = sorted([tuple(r) for r in report.collect()], key=str)
    assert rows == [(c, 0, 0, 0, 0, 0, 0, "") for c in (1, 3, None)]


def test_whole_table(spark):
    groups = defaultdict(list)
    for r in spark.read.parquet(f"{MIDDLE}/conversations.parquet").collect():
        conv, turn, role, text = r["conv_id"], r["turn"], r["role"], r["text"]
        rows = groups[conv]
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert sorted(map(tuple, QUERIES["op11_conversation_repair"].run(spark, MIDDLE).collect()), key=str) == expected(groups)
