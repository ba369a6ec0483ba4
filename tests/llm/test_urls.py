from __future__ import annotations

from collections import defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from paperloom.llm import urls
from paperloom.llm.queries import QUERIES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


LINK = '<html><head><link rel="canonical" href="{}"></head>'
JUMP = "<META content='0; URL={}' http-equiv=Refresh >"
PAGES = [
    (1, "http://a.example.net/x", LINK.format("https://shop.com/de/1")),  # the target is blocked
    (2, "https://a.example.net/x/#top", None),  # the same node as page 1
    (3, "http://b.example.net/y?utm_source=q", JUMP.format("http://a.example.net/x")),
    (4, "http://c.example.net/z", LINK.format("/moved") + JUMP.format("//d.example.net/q?a=1&amp;b=2")),
    (5, "https://d.example.net/q?a=1&b=2", LINK.format("http://www.example.org/es/7")),
    (6, "http://c.example.net/moved", LINK.format("http://good.org/")),  # allowed, which comes first
    (7, "http://www.example.org/es/7", ""), (8, "http://www.EXAMPLE.org/en/15", "<link rel=canonical href=x>"),
    (9, "http://example.org/en/25", ""), (10, "http://good.org", ""), (11, None, LINK.format("http://x.com/de/")),
    (12, "no scheme.com/de/", JUMP.format("http://x.com/de/")), (13, "", "<link"), (14, "http://x.com/fr/1", LINK.format("http://y.com/de/1")),
    (15, "http://y.com/de/1", None), (15, "http://y.com/de/1", None), (16, "://x.com/de/1?x", None),
    (17, "http://notexample.org.net/es/", None), (18, "http://e.example.net/long", "<link " * 20_000),
    (None, "HTTP://Ü.COM/de/", None), (19, "http://f.example.net/" + "p" * 50_000, LINK.format("#same")),
]
WANT = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "allow",
        11: "allow", 12: "allow", 13: "allow", 14: "allow", 15: "block", 16: "block", 17: "allow", 18: "allow", None: "block",
        19: "allow"}


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, h, "h", "n") for i, u, h in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, node string").repartition(3)


def test_odd_pages(pages):
    rows = urls.judge(pages).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        host, path = plain_parts(r["row"]["url"])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert r["verdict"] == WANT[r["row"]["page_id"]], r["row"]["page_id"]
        assert rule is None or r["verdict"] == rule.verdict


def test_allowed_pages_keep_their_columns(pages):
    kept = urls.allowed(pages)
    assert kept.columns == pages.columns
    assert sorted(r["page_id"] for r in kept.collect()) == sorted(i for i, v in WANT.items() if v == "allow")
    assert urls.judge(pages.limit(0)).collect() == []


def test_many_aliases_of_one_page(spark):
    rows = [(i, f"http://h{i}.example.net/p", LINK.format("http://hub.example.net/")) for i in range(400)]
    rows.append((400, "http://hub.example.net/", LINK.format("http://z.com/de/")))
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["verdict"] for r in got} == {"block"} and len(got) == 401


def test_whole_table(spark):
    rows = QUERIES["op8_url_filters"].run(spark, SMALL).collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        host, path = plain_parts(pages[r["page_id"]])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert rule is None or r["verdict"] == rule.verdict
