"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

A document's features are the lower-case words it holds, and the first four and five letters of
them, each counted once. One weight vector is shared by all thresholds:
``P(grade > g) = sigmoid(w x - c_g)`` with ``c_0 < c_1 < ...``; the expected severity is the sum of
these probabilities, from 0 to the highest grade.

The model is fitted on a bounded sample of labelled documents: about ``sample`` rows in the order
of a hash, equal texts counted once. Spark counts the features per grade; those that are too rare
or not tied to a grade are dropped, and at most ``features`` remain. The fit itself sees one short
list of feature numbers per sampled row. Every document is then scored from its whole text.

Where labels say only toxic or not, an order is made of them: a toxic document's grade grows with
the number of its features that mark toxic documents, cut at the terciles.

Defined results: a null, empty or word-free text has no features and gets the severity that the
thresholds alone give; repeated rows are scored alike; without labelled rows, or with one grade
only, the severity is that constant grade. Columns of the documents are kept whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import in_share, text_function, whole

SAMPLE = 20_000
FEATURES = 4096
LEAST_ROWS = 4
PREFIXES = (4, 5)
WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    # A prefix is marked, so that it differs from the word of the same letters.
    return words.union(*({f"{w[:n]}*" for w in words if len(w) > n} for n in PREFIXES))


@dataclass
class Model:
    """Weights by feature and the ordered cuts between grades."""

    weights: dict[str, float] = field(default_factory=dict)
    cuts: list[float] = field(default_factory=list)
    constant: int = 0

    def __post_init__(self) -> None:
        self.words = {f: w for f, w in self.weights.items() if not f.endswith("*")}
        self.heads = [(n, {f[:-1]: w for f, w in self.weights.items() if f.endswith("*") and len(f) == n + 1})
                      for n in PREFIXES]

    def probabilities(self, text: str | None) -> list[float]:
        """``P(grade > g)`` for each cut."""
        words = set(WORD.findall((text or "").lower()))
        hits = [self.words[w] for w in self.words.keys() & words]
        for n, heads in self.heads:
            hits += [heads[h] for h in heads.keys() & {w[:n] for w in words if len(w) > n}]
        score = float(np.sum(np.sort(hits))) if hits else 0.0
        return [float(1 / (1 + np.exp(min(60.0, max(-60.0, c - score))))) for c in self.cuts]

    def severity(self, text: str | None) -> float:
        return float(sum(self.probabilities(text))) if self.cuts else float(self.constant)


def fit_cumulative(rows: list[list[int]], grades: np.ndarray, width: int, *, steps: int = 600,
                   penalty: float = 3e-5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of the proportional-odds model by gradient steps with momentum.

    The gaps between cuts are exponentials, so the cuts stay in order. Weights stay at 0 or above:
    a mark of toxic text is not made up for by the words around it.
    """
    top = int(grades.max())
    lengths = np.array([len(r) for r in rows])
    columns = np.concatenate([np.array(r, np.int64) for r in rows]) if lengths.sum() else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    weight = 1.0 / len(rows)
    params = np.concatenate([np.zeros(width), [0.0], np.zeros(top - 1)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, gaps = params[:width], np.exp(params[width + 1:])
        cuts = params[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, w[columns], len(rows)) if len(columns) else np.zeros(len(rows))
        upper = np.where(grades < top, cuts[np.minimum(grades, top - 1)] - score, 60.0)
        lower = np.where(grades > 0, cuts[np.maximum(grades, 1) - 1] - score, -60.0)
        hi, lo = 1 / (1 + np.exp(-np.clip(upper, -60, 60))), 1 / (1 + np.exp(-np.clip(lower, -60, 60)))
        chance = np.maximum(hi - lo, 1e-9)
        d_hi = np.where(grades < top, hi * (1 - hi), 0.0) / chance * weight
        d_lo = np.where(grades > 0, lo * (1 - lo), 0.0) / chance * weight
        by_row = d_hi - d_lo  # of the loss with respect to the score
        g_cuts = np.bincount(np.maximum(grades, 1) - 1, d_lo, top) - np.bincount(np.minimum(grades, top - 1), d_hi, top)
        tails = np.cumsum(g_cuts[::-1])[::-1]
        g_w = np.bincount(columns, by_row[owner], width) if len(columns) else np.zeros(width)
        gradient = np.concatenate([g_w + penalty * w, tails[:1], tails[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        params -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
        np.maximum(params[:width], 0.0, out=params[:width])
    return params[:width], params[width] + np.concatenate([[0.0], np.cumsum(np.exp(params[width + 1:]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: Column, *, id_col: str, text_col: str,
                    sample: int) -> DataFrame:
    """``text, grade`` of about ``sample`` labelled rows, the same on every run; equal texts once.

    ``grade`` is an expression on the labels. The rate is taken from the number of labels, and the
    sampled labels, one row per id, are what the documents are joined with.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), grade.cast("int").alias("grade")).dropna()
    n = marks.count()
    if n > sample:
        marks = marks.where(in_share(F.xxhash64("id"), sample, n))
    marks = marks.groupBy("id").agg(F.max("grade").alias("grade"))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = texts.where(F.col("text").isNotNull()).join(marks, "id")
    return rows.groupBy(F.md5(F.col("text").cast("binary")).alias("key")).agg(
        F.max("grade").alias("grade"), F.min("id").alias("id"), F.first("text").alias("text")).select("text", "grade")


def train(docs: DataFrame, labels: DataFrame, grade: Column, *, binary: bool = True, id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE, limit: int = FEATURES) -> Model:
    """Fit on the labelled sample. ``binary`` says that the grade is 0 or 1 and is to be refined."""
    def extract(texts: list[str | None]) -> list[list[str]]:
        return [sorted(features(t)) for t in texts]

    from ..session import materialize

    rows = labelled_sample(docs, labels, grade, id_col=id_col, text_col=text_col, sample=sample)
    listed = text_function(extract, "array<string>", pa.list_(pa.string()), 32)
    rows = materialize(rows.select(
        "grade", F.xxhash64("text").alias("key"), listed("text").alias("features")), "toxic-sample")
    sizes = {r["grade"]: r["n"] for r in rows.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(constant=max(0, *sizes) if sizes else 0)
    n, positive = sum(sizes.values()), sum(c for g, c in sizes.items() if g > 0)
    # How much likelier a feature is above grade 0, and how sure that is (a z value of log odds).
    p = (F.col("pos") + 0.5) / (positive + 1)
    q = (F.col("all") - F.col("pos") + 0.5) / (n - positive + 1)
    spread = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("all") - F.col("pos") + 0.5))
    ranked = (
        rows.select(F.explode("features").alias("feature"), F.col("grade"))
        .groupBy("feature").agg(F.count("*").alias("all"), F.sum((F.col("grade") > 0).cast("int")).alias("pos"))
        .where(F.col("all") >= LEAST_ROWS)
        .withColumn("odds", F.log(p) - F.log(q)).withColumn("z", F.col("odds") / spread)
        .where(F.col("z") >= 3).orderBy(F.desc("z"), "feature").limit(limit).collect()
    )
    chosen = sorted(r["feature"] for r in ranked)
    if not chosen:
        return Model(constant=0)
    marks = {r["feature"] for r in ranked if r["odds"] > 2}
    spark = docs.sparkSession
    table = spark.createDataFrame([(f, i, f in marks) for i, f in enumerate(chosen)], "feature string, number int, mark boolean")
    hits = (
        rows.select("key", F.explode("features").alias("feature")).join(F.broadcast(table), "feature")
        .groupBy("key").agg(F.sort_array(F.collect_list("number")).alias("numbers"),
                            F.sum(F.col("mark").cast("int")).alias("marks"))
    )
    found = rows.select("key", "grade").join(hits, "key", "left").orderBy("key").collect()
    grades = np.array([r["grade"] for r in found], np.int64)
    if binary:
        marks = np.array([r["marks"] or 0 for r in found])
        toxic = grades > 0
        cuts = np.quantile(marks[toxic], [1 / 3, 2 / 3])
        grades = np.where(toxic, 1 + (marks > cuts[0]) + (marks > cuts[1]), 0)
        grades = np.searchsorted(np.unique(grades), grades)  # without gaps between the grades
    weights, cuts = fit_cumulative([r["numbers"] or [] for r in found], grades, len(chosen))
    return Model({f: float(w) for f, w in zip(chosen, weights) if w > 0}, [float(c) for c in cuts])


SCORED = pa.struct([("severity", pa.float64()), ("grade", pa.int32()), ("p_toxic", pa.float64())])


def severity(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of the document), ``severity``, ``grade`` and ``p_toxic``.

    ``p_toxic`` is the probability of any grade above 0; ``grade`` counts the cuts passed with
    probability one half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: list[str | None]) -> list[dict]:
        out = []
        for text in texts:
            p = shared.value.probabilities(text)
            if not p:
                p = [1.0] * shared.value.constant
            out.append({"severity": float(sum(p)), "grade": sum(x >= 0.5 for x in p), "p_toxic": p[0] if p else 0.0})
        return out

    scored = text_function(score, "struct<severity:double,grade:int,p_toxic:double>", SCORED)
    out = docs.select(whole(docs).alias("row"), scored(F.col(f"`{text_col}`").cast("string")).alias("s"))
    return out.select("row", "s.severity", "s.grade", "s.p_toxic")


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents of grade 0, with their own columns."""
    return severity(docs, model, text_col=text_col).where(F.col("grade") == 0).select("row.*")
