"""Profiling: missing values, duplicates, distributions, lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions.core import is_blank
from ..session import materialize
from .ordering import value_quantiles


def _missing(df: DataFrame, column: str, blanks: bool) -> Column:
    if blanks and isinstance(df.schema[column].dataType, StringType):
        return is_blank(column)
    return F.col(column).isNull()


def _one_row_per_column(row: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("missing")) for c in columns]
    )
    rest = [c for c in row.columns if not c.startswith("m_")]
    return row.select(*rest, F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    """``column, missing`` for every column, in one scan."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in df.columns])
    return _one_row_per_column(row, df.columns)


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with gaps: count and share in percent. White space counts as missing."""
    counts = [F.count_if(_missing(df, c, True)).alias(f"m_{c}") for c in df.columns]
    row = df.agg(F.count("*").alias("n"), *counts)
    return (
        _one_row_per_column(row, df.columns)
        .where(F.col("missing") > 0)
        .select(
            "column",
            F.col("missing").alias("missing_count"),
            pct_round("missing", "n").alias("missing_ratio"),
        )
    )


def missing_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """``column, id`` for every gap: the id lists of the report in long form, without a shuffle."""
    gaps = F.array(
        *[F.when(_missing(df, c, True), F.lit(c)) for c in df.columns if c != id_col]
    )
    return df.select(F.col(id_col).alias("id"), F.explode(F.array_compact(gaps)).alias("column"))


def pct_round(part: Column | str, whole: Column | str) -> Column:
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.round(part / whole * 100, 2)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


LONG_KEY = 64
MOST_LABELS = 10_000


def _short_key(df: DataFrame, column: str) -> Column:
    """Long strings as their SHA-256, so that a shuffle by a text does not move the text."""
    x = F.col(column)
    if not isinstance(df.schema[column].dataType, StringType):
        return x
    digest = F.concat(F.lit("sha256:"), F.sha2(x, 256))
    return F.when(F.length(x) > LONG_KEY, digest).otherwise(x).alias(column)


def dup_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key; nulls equal each other."""
    columns = list(keys or df.columns)
    short = df.select(*[_short_key(df, c) for c in columns])
    groups = short.groupBy(*columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def dup_counts(df: DataFrame, keys: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """``key, duplicates`` for several keys from one scan; null for a key stands for all columns.

    Every column is digested once; a row then gives one digest per key.
    """
    columns = {c: F.coalesce(F.sha2(F.col(c).cast("string"), 256), F.lit("")) for c in df.columns}
    digests = df.select(*[d.alias(c) for c, d in columns.items()])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("key"), F.sha2(F.concat_ws(",", *(key or df.columns)), 256).alias("digest"))
        for name, key in keys.items()])
    groups = digests.select(F.inline(pairs)).groupBy("key", "digest").agg(F.count("*").alias("n"))
    found = groups.groupBy("key").agg(F.sum(F.col("n") - 1).alias("duplicates"))
    names = df.sparkSession.createDataFrame([(k,) for k in keys], "key string")
    return names.join(found, "key", "left").select("key", F.coalesce("duplicates", F.lit(0)).alias("duplicates"))


def dup_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """All rows whose key occurs more than once.

    Keys are counted map-side first; the rows are then filtered by a semi join, where AQE
    splits a hot key, instead of being collected into one window per key.
    """
    many = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    return df.join(many, key, "left_semi")


def _moments(df: DataFrame, column: str) -> DataFrame:
    """``v, c``: every distinct value with its count, written once.

    Means and quantiles both follow from this table, so the rows are read a single time.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v"))
    return materialize(values.agg(F.count("*").alias("c")), "values")


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles (linear), maximum."""
    values = _moments(df, column)
    mean = F.sum(F.col("v") * F.col("c")) / F.sum("c")
    first = values.agg(
        F.sum("c").alias("count"), mean.alias("mean"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    apart = (F.col("v") - F.col("m")) * (F.col("v") - F.col("m")) * F.col("c")
    variance = values.withColumn("m", values.agg(mean).scalar()).agg(
        F.when(F.sum("c") > 1, F.sum(apart) / (F.sum("c") - 1))
    )
    q = value_quantiles(values, "v", "c", (0.25, 0.5, 0.75)).scalar()
    return first.withColumns({"_q": q, "std": F.sqrt(variance.scalar())}).select(
        F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min",
        F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"),
        "max",
    )


def length_stats(df: DataFrame, length: Column) -> DataFrame:
    """n, mean, median, maximum, 95th and 99th percentile of a length."""
    values = _moments(df.select(length.alias("len")), "len")
    row = values.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("mean"),
        F.max("v").alias("max_len"),
    )
    q = value_quantiles(values, "v", "c", (0.5, 0.95, 0.99)).scalar()
    return row.withColumn("_q", q).select(
        "n", "mean", F.col("_q")[0].alias("median"), "max_len",
        F.col("_q")[1].alias("p95"), F.col("_q")[2].alias("p99"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """``bin, low, high, n`` for equal-width bins between minimum and maximum; empty ones too.

    Values are counted first, so the binning itself runs on one row per distinct value.
    """
    values = _moments(df, column).withColumn("v", F.col("v").cast("double"))
    bounds = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    binned = values.withColumn("b", bounds).withColumn("w", width)
    nr = F.when(
        F.col("w") > 0, F.least(F.lit(bins), F.floor((F.col("v") - F.col("b.lo")) / F.col("w")) + 1)
    ).otherwise(F.lit(1))
    counts = binned.groupBy(nr.cast("int").alias("bin")).agg(F.sum("c").alias("c"))
    spine = (
        df.sparkSession.range(1, bins + 1)
        .select(F.col("id").cast("int").alias("bin"))
        .withColumn("b", bounds)
        .withColumn("w", width)
    )
    low = F.col("b.lo") + (F.col("bin") - 1) * F.col("w")
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin", low.alias("low"), (low + F.col("w")).alias("high"),
        F.coalesce("c", F.lit(0)).cast("long").alias("n"),
    )


def label_share(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and percent per label, and the ratio of the largest to the smallest count.

    The labels are few, so the second step works on the handful of count rows.
    """
    counts = value_counts(df, label)
    stats = counts.agg(
        F.struct(F.sum("n").alias("total"), F.max("n").alias("hi"), F.min("n").alias("lo"))
    ).scalar()
    return counts.withColumn("s", stats).select(
        label, "n", pct_round("n", "s.total").alias("pct"),
        (F.col("s.hi") / F.col("s.lo")).alias("imbalance"),
    )


def label_range(df: DataFrame, label: str = "label") -> DataFrame:
    """Smallest and largest label, and the labels themselves; more than ``MOST_LABELS`` is an error,
    since a column of that many values is no label."""
    few = df.select(label).distinct().limit(MOST_LABELS + 1).agg(
        F.min(label).alias("min_label"), F.max(label).alias("max_label"),
        F.sort_array(F.collect_list(label)).alias("labels"))
    too_many = F.raise_error(F.lit("too many different labels")).cast(few.schema["labels"].dataType)
    return few.withColumn("labels", F.when(F.size("labels") > MOST_LABELS, too_many).otherwise(F.col("labels")))


def fold_distribution(df: DataFrame, labels: Sequence[int], label: str = "label",
                      fold: str = "fold") -> DataFrame:
    """One row per fold, one count column per label, 0 for an absent label."""
    counts = [F.count_if(F.col(label) == v).alias(f"label_{v}") for v in labels]
    return df.groupBy(fold).agg(*counts, F.count("*").alias("n"))


def fold_spread(folds: DataFrame, labels: Sequence[int], limit: float = 5.0) -> DataFrame:
    """Sample deviation across folds per label, and whether it is over the limit."""
    row = folds.agg(*[F.stddev_samp(f"label_{v}").alias(f"s_{v}") for v in labels])
    pairs = F.array(
        *[F.struct(F.lit(v).alias("label"), F.col(f"s_{v}").alias("std")) for v in labels]
    )
    return row.select(F.inline(pairs)).withColumn("uneven", F.col("std") > limit)


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values; equal counts in value order."""
    return value_counts(df, column).orderBy(F.desc("n"), F.col(column)).limit(k)


def corpus_size(df: DataFrame) -> DataFrame:
    """Row count, column count and column names."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )
