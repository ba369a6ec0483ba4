"""Exact stratified folds and splits, fold averages and out-of-fold assembly."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from .ordering import ordered_within


def stratified_kfold(df: DataFrame, k: int = 5, label: str = "label", id_col: str = "id") -> DataFrame:
    """``id, label, fold``: each label dealt round over k folds in md5 order of the id.

    Fold sizes differ by at most one per label. All copies of an id get the same fold.
    """
    placed = ordered_within(df, label, id_col)
    return placed.select(id_col, label, (F.col("position") % k).cast("int").alias("fold"))


def stratified_split(df: DataFrame, test_size: float = 0.2, label: str = "label",
                     id_col: str = "id") -> DataFrame:
    """``id, label, split``: the first rounded share of each label is the test set."""
    placed = ordered_within(df, label, id_col)
    is_test = F.col("position") < F.round(F.col("n") * test_size)
    return placed.select(id_col, label, F.when(is_test, "test").otherwise("train").alias("split"))


def with_folds(df: DataFrame, k: int = 5, label: str = "label", id_col: str = "id") -> DataFrame:
    """Add ``fold``. The join is on id and label, so an id with two labels keeps its rows apart."""
    return df.join(stratified_kfold(df, k, label, id_col), [id_col, label])


def with_split(df: DataFrame, test_size: float = 0.2, label: str = "label",
               id_col: str = "id") -> DataFrame:
    """Add ``split``."""
    return df.join(stratified_split(df, test_size, label, id_col), [id_col, label])


def fold_average(scores: DataFrame, id_col: str = "id", column: str = "score") -> DataFrame:
    """Mean score per record over the fold models."""
    return scores.groupBy(id_col).agg(F.avg(column).alias(column))


def fold_average_vectors(scores: DataFrame, size: int, id_col: str = "id",
                         column: str = "probability") -> DataFrame:
    """Mean probability array per record; the arrays are summed entry by entry map-side."""
    means = [F.avg(F.col(column)[i]) for i in range(size)]
    return scores.groupBy(id_col).agg(F.array(*means).alias(column))


def oof_assemble(parts: Mapping[int, DataFrame]) -> DataFrame:
    """Stack the scores that each fold's model gave to the rows it had not seen."""
    out = None
    for fold, part in parts.items():
        marked = part.withColumn("fold", F.lit(fold))
        out = marked if out is None else out.unionByName(marked)
    return out
