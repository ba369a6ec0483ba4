"""Quality rules as a short-circuit cascade.

A rule rejects a document. Each rule is timed on a sample of the documents together with the share
of them it rejects, and the cascade tries the rules by rejections per second, most first; the first
rule that rejects ends it. The order changes only what the cascade costs: a document is kept if
no rule rejects it.

Measures are computed when a rule first asks for them, from the whole text, and remembered for the
document, so a rule that needs nothing new is nearly free once another has run.

Defined results: a null text has no words; an empty or word-free text is rejected by ``few_words``;
repeated rows are judged alike; on an empty table the rules stay in the given order. Columns of the
documents are kept whatever their names.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import sampled_texts, text_function, whole

SAMPLE = 2_000
WINDOW = 5
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = re.compile(r"[A-Z]{2}")


class Measures:
    """What rules ask about a text."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII space only

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that stand in a window of five found twice or more."""
        n = len(self.words)
        if n <= WINDOW:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in self.words), np.int64, n)
        v = len(numbers)
        # Ranks of pairs, of fours, and of five words: exact, and small enough for 64 bits.
        two = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
        four = np.unique(two[:-2] * n + two[2:], return_inverse=True)[1]
        _, five, count = np.unique(four[:-1] * v + ids[4:], return_inverse=True, return_counts=True)
        again = count[five] > 1
        edge = np.zeros(n + 1, np.int64)
        edge[:len(again)] += again
        edge[WINDOW:WINDOW + len(again)] -= again
        return int((np.cumsum(edge[:-1]) > 0).sum())

    @cached_property
    def n_letters(self) -> int:
        return sum(map(str.isalpha, self.text))

    @cached_property
    def n_shouts(self) -> int:
        return self.text.count("!")

    @cached_property
    def n_upper_pairs(self) -> int:
        return len(UPPER.findall(self.text))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


# The limits are parameters of the rules, fixed here in one place.
RULES = (
    Rule("few_words", lambda m: len(m.words) < 10),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * len(m.words)),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 30 * len(m.lines)),
    Rule("symbols", lambda m: 100 * m.n_symbols > 20 * len(m.words)),
    Rule("shouting", lambda m: 100 * m.n_shouts > 20 * len(m.words)),
    Rule("capitals", lambda m: 100 * m.n_upper_pairs > 40 * len(m.words)),
    Rule("word_length", lambda m: not 2 * len(m.words) <= m.word_chars <= 15 * len(m.words)),
    Rule("few_letters", lambda m: 100 * m.n_letters < 60 * m.word_chars),
)


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, *, text_col: str = "text",
                  sample: int = SAMPLE) -> list[Rule]:
    """The rules by rejections per second on about ``sample`` different texts, most first.

    The sample follows a hash of the text, copies count once. Every rule is timed on measures of its own, so that its
    cost holds all it needs; the sums over the sample are one small row per rule.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = sampled_texts(docs.select(text.alias("text")), sample)

    def trial(texts: list[str | None]) -> list[list[dict]]:
        out = []
        for t in texts:
            row = []
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                rejected = rule.rejects(Measures(t))
                row.append({"rule": k, "seconds": time.perf_counter() - began, "rejected": int(rejected)})
            out.append(row)
        return out

    kind = pa.list_(pa.struct([("rule", pa.int32()), ("seconds", pa.float64()), ("rejected", pa.int32())]))
    timed = text_function(trial, "array<struct<rule:int,seconds:double,rejected:int>>", kind)
    sums = (
        rows.select(F.explode(timed("text")).alias("t")).groupBy("t.rule")
        .agg(F.sum("t.seconds").alias("seconds"), F.sum("t.rejected").alias("rejected")).collect()
    )
    gain = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in sums}
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: (-gain.get(k, 0.0), k))]


MEASURED = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                      ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("rejected_by", pa.string())])
MEASURED_DDL = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
                "rejected_by:string>")


def cascade(docs: DataFrame, rules: Sequence[Rule], *, text_col: str = "text", measures: bool = False) -> DataFrame:
    """``row`` (all columns of the document) and ``q``: the rule that rejected it, or null.

    With ``measures``, ``q`` holds the counts too, which are then computed for every document.
    """
    def judge(texts: list[str | None]) -> list[dict]:
        out = []
        for t in texts:
            m = Measures(t)
            row = {"rejected_by": next((r.name for r in rules if r.rejects(m)), None)}
            if measures:
                row |= {"n_words": len(m.words), "word_chars": m.word_chars, "n_symbols": m.n_symbols,
                        "n_dup_lines": m.n_dup_lines, "n_repeat_words": m.n_repeat_words}
            out.append(row)
        return out

    judged = text_function(judge, MEASURED_DDL, MEASURED)
    return docs.select(whole(docs).alias("row"), judged(F.col(f"`{text_col}`").cast("string")).alias("q"))


def kept(docs: DataFrame, rules: Sequence[Rule] = RULES, *, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    order = ordered_rules(docs, rules, text_col=text_col)
    return cascade(docs, order, text_col=text_col).where(F.col("q.rejected_by").isNull()).select("row.*")
