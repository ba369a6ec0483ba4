"""Scores of predictions against ordinal labels.

Everything is computed from counts per (label, prediction): one scan, one row per task, no
shuffle of the scored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.core import col
from ..functions.labels import LABELS, in_domain


def _ratio(a: Column, b: Column) -> Column:
    """a / b, with 0 for 0/0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def accuracy(label: Column | str, prediction: Column | str) -> Column:
    return F.avg((col(label) == col(prediction)).cast("double"))


def qwk(label: Column | str, prediction: Column | str) -> Column:
    """Quadratic weighted kappa as one aggregate.

    With weights (y-p)^2 the expected disagreement of the two marginals is
    n*sum(y^2) + n*sum(p^2) - 2*sum(y)*sum(p), divided by n, so plain sums are enough.
    """
    y, p = col(label).cast("double"), col(prediction).cast("double")
    n = F.count(y + p)
    seen = n * F.sum((y - p) * (y - p))
    expected = n * F.sum(y * y) + n * F.sum(p * p) - 2 * F.sum(y) * F.sum(p)
    return F.when(expected != 0, 1 - seen / expected)


def _counts(label: Column | str, prediction: Column | str, k: int) -> tuple[Column, Column, Column]:
    y, p = col(label), col(prediction)
    return F.count_if((y == k) & (p == k)), F.count_if(y == k), F.count_if(p == k)


def macro_f1(label: Column | str, prediction: Column | str,
             labels: Sequence[int] = LABELS) -> Column:
    """Mean F1 over the labels present in truth or prediction, as one aggregate.

    A label outside the set fails the job, because the mean would silently leave it out.
    """
    outside = F.count_if(~col(label).isin(*labels) | ~col(prediction).isin(*labels))
    checked = F.when(outside > 0, F.raise_error(F.lit("a label outside the set")).cast("double"))
    total, present = F.lit(0.0), F.lit(0)
    for k in labels:
        hit, truth, said = _counts(label, prediction, k)
        total = total + _ratio(2.0 * hit, truth + said)
        present = present + F.when(truth + said > 0, 1).otherwise(0)
    return checked.when(present > 0, total / present)


def combined_objective(label: Column | str, prediction: Column | str, f1_weight: float = 0.4) -> Column:
    return (1 - f1_weight) * qwk(label, prediction) + f1_weight * macro_f1(label, prediction)


def scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All scores in one row."""
    return df.agg(
        F.count("*").alias("n"),
        accuracy(label, prediction).alias("accuracy"),
        qwk(label, prediction).alias("qwk"),
        macro_f1(label, prediction).alias("macro_f1"),
        combined_objective(label, prediction).alias("objective"),
    )


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``y, p, n``: rows per label and prediction; rows that lack one of them are left out."""
    pairs = df.select(F.col(label).alias("y"), F.col(prediction).alias("p")).dropna()
    return pairs.groupBy("y", "p").agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n`` for every pair of labels found in truth or prediction, empty pairs
    included. The label set comes from the data, so no row is lost."""
    counts = pair_counts(df, label, prediction)
    ends = F.explode(F.array("y", "p"))
    seen = counts.select(ends.alias("v")).agg(F.collect_set("v").alias("seen"))
    grid = seen.select(F.explode("seen").alias("y"), "seen").select("y", F.explode("seen").alias("p"))
    return grid.join(counts, ["y", "p"], "left").select(
        F.col("y").alias("label"), F.col("p").alias("prediction"), F.coalesce("n", F.lit(0)).alias("n"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro and weighted means.

    The labels are those found in truth or prediction, whatever their values.
    """
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y").alias("k"), F.col("n").alias("truth"), zero.alias("said"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero).alias("hit")),
        F.struct(F.col("p").alias("k"), zero.alias("truth"), F.col("n").alias("said"), zero.alias("hit")))
    per_label = pair_counts(df, label, prediction).select(F.inline(sides)).groupBy("k").agg(
        *[F.sum(c).alias(c) for c in ("truth", "said", "hit")])
    row = per_label.agg(
        F.sum("truth").alias("n"), F.sum("hit").alias("hits"),
        F.sort_array(F.collect_list(F.struct("k", "truth", "said", "hit"))).alias("c"))
    classes = F.transform("c", lambda c: F.struct(
        c["k"].cast("string").alias("class"), _ratio(c["hit"], c["said"]).alias("precision"),
        _ratio(c["hit"], c["truth"]).alias("recall"),
        _ratio(2.0 * c["hit"], c["truth"] + c["said"]).alias("f1"), c["truth"].alias("support")))
    listed = row.select("n", "hits", classes.alias("c"))

    def mean(field: str, weight: Column | None = None) -> Column:
        def add(acc: Column, c: Column) -> Column:
            return acc + c[field] * (F.lit(1.0) if weight is None else c["support"])

        whole = F.size("c") if weight is None else weight
        return _ratio(F.aggregate("c", F.lit(0.0), add), whole)

    hit_share = _ratio(F.col("hits").cast("double"), F.col("n"))

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1"), F.col("n").alias("support"),
        )

    per_class = F.transform(
        "c",
        lambda c: F.struct(
            c["class"].alias("class"), c["precision"].alias("precision"),
            c["recall"].alias("recall"), c["f1"].alias("f1"), c["support"].alias("support"),
        ),
    )
    means = F.array(
        line("accuracy", hit_share, hit_share, hit_share),
        line("macro avg", *[mean(f) for f in ("precision", "recall", "f1")]),
        line("weighted avg", *[mean(f, F.col("n")) for f in ("precision", "recall", "f1")]),
    )
    return listed.select(F.inline(F.concat(per_class, means)))


def _label_counts(df: DataFrame, label: str, labels: Sequence[int]) -> DataFrame:
    return df.agg(F.array(*[F.count_if(F.col(label) == k) for k in labels]).alias("counts"))


def class_weights(df: DataFrame, label: str = "label", labels: Sequence[int] = LABELS) -> DataFrame:
    """``label, weight``: n / (k * count), divided by the mean weight; no class may be empty."""
    row = _label_counts(df, label, labels)
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    inverse = F.transform(
        "counts",
        lambda c: F.when(c > 0, n / (len(labels) * c)).otherwise(
            F.raise_error(F.lit("a label has no rows")).cast("double")
        ),
    )
    weights = row.select(inverse.alias("w"))
    mean = F.aggregate("w", F.lit(0.0), lambda a, w: a + w) / len(labels)
    pairs = F.array(
        *[F.struct(F.lit(k).alias("label"), (F.col("w")[i] / mean).alias("weight"))
          for i, k in enumerate(labels)]
    )
    return weights.select(F.inline(pairs))


def balanced_weight(df: DataFrame, label: str = "label", labels: Sequence[int] = LABELS,
                    name: str = "weight") -> DataFrame:
    """Add n / (k * count of the row's label), k being the number of labels present."""
    counts = _label_counts(df, label, labels).select("counts").scalar()
    n = F.aggregate("_c", F.lit(0).cast("long"), lambda a, c: a + c)
    k = F.size(F.filter("_c", lambda c: c > 0))
    own = F.get(F.col("_c"), F.array_position(F.array(*map(F.lit, labels)), F.col(label)).cast("int") - 1)
    return df.withColumn("_c", counts).withColumn(name, n / (k * own)).drop("_c")


def domain_check(df: DataFrame, label: str = "Label") -> DataFrame:
    """``Label, n, valid``: distribution of the labels, each marked as in the domain or not."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("valid", F.coalesce(in_domain(label), F.lit(False)))


def cv_mean_score(df: DataFrame, fold: str = "fold", label: str = "label",
                  prediction: str = "prediction") -> DataFrame:
    """Mean over folds of the macro-F1 of each fold."""
    per_fold = df.groupBy(fold).agg(macro_f1(label, prediction).alias("score"))
    return per_fold.agg(F.avg("score").alias("mean_score"), F.count("*").alias("folds"))


def llm_eval(df: DataFrame, replies: Column | str, n: int = 50, id_col: str = "id") -> DataFrame:
    """Parse the replies of the first ``n`` records and keep those with a score."""
    from ..functions.labels import parse_llm_json

    head = df.orderBy(id_col).limit(n)
    scored = head.withColumn("_r", parse_llm_json(replies)).withColumns(
        {"llm_score": F.col("_r.score"), "llm_reason": F.col("_r.reason")}
    )
    return scored.drop("_r").where(F.col("llm_score").isNotNull())
