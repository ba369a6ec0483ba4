from __future__ import annotations

import hashlib
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from paperloom.llm import pii
from paperloom.llm.queries import QUERIES

# The rules as the contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def valid(kind: str, hit: str) -> bool:
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text: str | None) -> list[tuple[str, int, int]]:
    found = [(m.start(), k, pii.KINDS[k], m.end()) for k in range(4) for m in re.finditer(PLAIN[pii.KINDS[k]], text or "")
             if valid(pii.KINDS[k], m.group())]
    return [(kind, start, stop) for start, _, kind, stop in sorted(found)]


def spans(column) -> list[tuple[str, int, int]]:
    return [(pii.KINDS[s["kind"]], s["start"], s["stop"]) for s in column]


ODD = [
    None, "", "nothing here", "a@b.cd_e@f.gh and x.y@z.w-v.u", "é😀 me@mail7.example.com, 1.2.3.4 300.1.1.1 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 or 4111-1111-1111-1112 or 0000000000000000000000", "+1 (942) 555-5600 +12 +1 2 3 4 5 6 7 8 9 (",
    " marks @a.b", "007.08.0255.1 0000000000256.1.1.1", "1" * 5000, "a" * 5000 + "@", "1.1." * 3000 + "x",
    "+1" * 2000, "x@y" + ".z" * 3000, "12 " * 4000, "me at home dot org, mail me: john [at] site [dot] com",
    "call (942) 555-5600 now", "2001:0db8:85a3:0000:0000:8a2e:0370:7334 host", "1234567890123\n45 +1\n234567890",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", "y", 0) for i, t in enumerate(ODD)] + [(None, ODD[4], None, None, None), (4, ODD[4], "x", "y", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, base string, spans string, row int").repartition(3)


def test_base_spans_of_odd_texts(odd):
    for r in pii.find(odd, pii.Model()).collect():
        assert spans(r["base"]) == spans(r["spans"]) == brute(r["row"]["text"])


def test_running_sum_of_many_blocks(spark):
    n = 256 * 256 + 300
    df = spark.range(1).select(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long")).alias("x"))
    got = df.select(pii.running(F.col("x")).alias("s")).first()["s"]
    assert got == [k * (k + 1) // 2 for k in range(n)]


def test_whole_table(spark):
    rows = QUERIES["op3_pii"].run(spark, SMALL).collect()
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        written = [f"{k}:{a}:{z}" for k, a, z in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in base) for k in pii.KINDS]


RIGHT = {"email": "{n}er [at] site{n} [dot] org", "ip": "2001:db8:{n}::8a2e:{n}", "card": "4111.1111.1111.{c}", "phone": "({p}) 555-{q}"}
WRONG = {"email": "look at node{n}.js", "ip": "12:{m}:{m}", "card": "4111.1111.1111.{d}", "phone": "{p} 555/{q}"}


def spoken(i, form):
    body = f"411111111111{1000 + i}"
    check = next(f"{1000 + i}{d}" for d in range(10) if luhn(f"{body}{d}"))
    wrong = next(f"{1000 + i}{d}" for d in range(10) if not luhn(f"{body}{d}"))
    letters = "abcdefghij"[i % 10] + "klmnopqrst"[i // 10 % 10]
    return form.format(n=letters if "er" in form or "node" in form else i % 9000 + 100, m=10 + i % 50, c=check, d=wrong, p=300 + i % 600, q=1000 + i)


@pytest.fixture(scope="module")
def learned(spark):
    texts = [f"words {i} and {spoken(i, form)} go here" for i in range(150) for forms in (RIGHT, WRONG) for form in forms.values()]
    texts += [f"write me{i}@home.org or call +1 (300) 555-{1000 + i} today" for i in range(60)]
    return pii.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_further_forms_are_found_and_wrong_ones_left(spark, learned):
    assert set(learned.thresholds) == set(pii.KINDS)
    right = [(k, spoken(i, RIGHT[k])) for k in pii.KINDS for i in range(200, 240)]
    wrong = [spoken(i, WRONG[k]) for k in pii.KINDS for i in range(200, 240)]
    wrong += ["We will meet at noon.Then we left", "Look at node.js now", "std::vector a::b", "at 12:30:45"]
    docs = spark.createDataFrame(list(enumerate([f"so {x} then" for _, x in right] + wrong)), "doc_id long, text string")
    found = {r["row"]["doc_id"]: r for r in pii.find(docs, learned).collect()}
    hits = [spans(found[i]["spans"]) == [(k, 3, 3 + len(x))] for i, (k, x) in enumerate(right)]
    assert sum(hits) >= 0.95 * len(hits)
    assert [wrong[i] for i in range(len(wrong)) if spans(found[len(right) + i]["spans"])] == []


def test_added_spans_never_overlap(spark, learned):
    text = "call +1 (312) 555-1234 or (312) 555-1234, 4111.1111.1111.1111 " * 3 + "x [at] y [dot] com [dot] de (312) 555-1234-4111 1111 1111 1111"
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), learned).first()
    found = sorted((s["start"], s["stop"]) for s in row["spans"])
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:])) and len(found) > len(row["base"])
    redacted = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string"), learned).first()["text"]
    assert "<phone>" in redacted and "(312) 555-1234," not in redacted


def test_very_many_candidates_end_soon(spark, learned):
    import time

    text = "4111 1111 1111 1112 (300) 555-1000 " * 10_000
    began = time.time()
    row = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), learned).first()
    assert len(row["spans"]) >= 10_000 and time.time() - began < 90


def test_empty_table(spark, odd):
    empty = odd.limit(0)
    assert pii.find(empty, pii.train(empty)).collect() == []


def test_training_reads_every_text_that_holds_a_proposal(spark, monkeypatch):
    """More texts than any sample had: all are labelled, copies once."""
    class Seen(Exception):
        pass

    def stop(df, name):
        raise Seen(name, df.count())

    monkeypatch.setattr(pii, "materialize", stop)
    docs = spark.range(25_000).select(F.concat(F.lit("write to a"), F.col("id").cast("string"), F.lit("@b.org")).alias("text"))
    with pytest.raises(Seen) as seen:
        pii.train(docs.unionAll(docs))
    assert seen.value.args == ("proposals", 25_000)
