"""Language identification by hierarchical discrimination.

A first model predicts the language family; inside the family, one linear support vector machine
for each pair of languages votes, and the language with most votes (then the largest sum of
margins) wins. Features are relative frequencies of hashed sequences of one to three letters of
the whole text, with single spaces between words.

The models are fitted by Spark on a bounded sample: about ``per_language`` different labelled texts of
each language, in the order of a hash, each once however many copies it has. Every language with a labelled
text is learned. Which families exist is a parameter; a language that is not listed
is a family of its own.

Defined results: null texts and texts without a letter are ``und`` with score 0; very long texts
count whole; repeated rows are judged alike and count as one text of each of their languages when the
models are fitted; without labelled rows every text is ``und``; with one
language there is nothing to decide and it gets score 1. Columns are kept whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import folded, sampled_texts, text_function, whole

PER_LANGUAGE = 800
DIMENSIONS = 1 << 12
GRAMS = (1, 2, 3)
SCALE = 100.0
UNKNOWN = "und"
# Which languages are close relatives.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
}


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def gram_numbers(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The hashed number of every letter sequence of the text; empty if it holds no letter."""
    chars, _ = folded(text, letters_only=True)
    if not (chars != 32).any():
        return np.zeros(0, np.int64)
    chars = np.concatenate([[np.uint64(32)], chars, [np.uint64(32)]]).astype(np.uint64)
    out = []
    for n in GRAMS:
        code = chars[:len(chars) - n + 1].copy()
        for k in range(1, n):
            code = code * np.uint64(65_599) + chars[k:len(chars) - n + 1 + k]
        code = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((code >> np.uint64(40)).astype(np.int64) % dimensions)
    return np.concatenate(out)


def frequencies(text: str | None) -> list[float]:
    numbers = gram_numbers(text or "")
    return (np.bincount(numbers, minlength=DIMENSIONS) * (SCALE / max(1, len(numbers)))).tolist()


@dataclass
class Model:
    """Weights per feature: a column for each family, then one for each pair of related languages."""

    families: list[str]
    members: dict[str, list[str]]
    weights: np.ndarray
    bias: np.ndarray
    pairs: dict[str, list[tuple[int, int, int]]]  # column, and the two places among the members

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            numbers = gram_numbers(text) if text and self.families else ()
            if not len(numbers):
                out.append((UNKNOWN, 0.0))
                continue
            counts = np.bincount(numbers, minlength=DIMENSIONS)
            used = np.flatnonzero(counts)
            score = (counts[used] * (SCALE / len(numbers))) @ self.weights[used] + self.bias
            level = score[:len(self.families)]
            chance = np.exp(level - level.max())
            best = int(np.argmax(chance))
            family, certainty = self.families[best], float(chance[best] / chance.sum())
            languages = self.members[family]
            votes, margins = np.zeros(len(languages)), np.zeros(len(languages))
            sure: list[list[float]] = [[] for _ in languages]
            for column, a, b in self.pairs[family]:
                margin = float(np.clip(score[column], -30, 30))
                votes[a if margin >= 0 else b] += 1
                margins[a] += margin
                margins[b] -= margin
                sure[a].append(1 / (1 + np.exp(-2 * margin)))
                sure[b].append(1 / (1 + np.exp(2 * margin)))
            winner = max(range(len(languages)), key=lambda i: (votes[i], margins[i], -i))
            certainty *= float(np.mean(sure[winner])) if sure[winner] else 1.0
            out.append((languages[winner], certainty))
        return out


def train(docs: DataFrame, usable: Column, *, text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a sample of the rows for which ``usable`` holds and text and language are known."""
    rows = docs.where(usable).select(
        F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).dropna()
    chosen = materialize(sampled_texts(rows, per_language), "language-texts")
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    if not languages:
        return Model([], {}, np.zeros((DIMENSIONS, 0)), np.zeros(0), {})
    extract = text_function(lambda texts: [frequencies(t) for t in texts], "array<double>", pa.list_(pa.float64()), 32)
    sample = materialize(chosen.select("lang", extract("text").alias("x")), "language-sample")
    vectors = sample.select("lang", array_to_vector("x").alias("features"))
    families = sorted({family_of(x) for x in languages})
    members = {f: [x for x in languages if family_of(x) == f] for f in families}
    if len(families) == 1:
        columns, bias = [np.zeros(DIMENSIONS)], [0.0]
    else:
        number = F.create_map(*[F.lit(v) for x in languages for v in (x, float(families.index(family_of(x))))])
        fit = LogisticRegression(regParam=1e-4, maxIter=20, family="multinomial", standardization=False).fit(
            vectors.withColumn("label", number[F.col("lang")]))
        matrix = fit.coefficientMatrix.toArray()
        intercepts = fit.interceptVector.toArray()
        columns, bias = list(matrix), intercepts.tolist()
    pairs: dict[str, list[tuple[int, int, int]]] = {}
    for family, group in members.items():
        pairs[family] = []
        for a, b in combinations(range(len(group)), 2):
            two = vectors.where(F.col("lang").isin(group[a], group[b]))
            machine = LinearSVC(regParam=1e-4, maxIter=20, standardization=False).fit(
                two.withColumn("label", (F.col("lang") == group[a]).cast("double")))
            pairs[family].append((len(columns), a, b))
            columns.append(machine.coefficients.toArray())
            bias.append(machine.intercept)
    return Model(families, members, np.array(columns).T.copy(), np.array(bias), pairs)


PREDICTED = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def identify(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of the document), ``lang_pred`` and ``score`` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: list[str | None]) -> list[dict]:
        return [{"lang_pred": lang, "score": score} for lang, score in shared.value.predict(texts)]

    predicted = text_function(predict, "struct<lang_pred:string,score:double>", PREDICTED)
    out = docs.select(whole(docs).alias("row"), predicted(F.col(f"`{text_col}`").cast("string")).alias("p"))
    return out.select("row", "p.lang_pred", "p.score")
