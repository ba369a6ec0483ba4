"""Global order without a global sort on one task.

Running totals, ranks and exact quantiles over a whole table would put every row into one
window partition. Here the ordered keys are cut into buckets whose order is known, each bucket
is ordered by itself, and the totals of the earlier buckets (one row per bucket) are added.
Keys are aggregated first, so a key that holds a third of all rows is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

BUCKETS = 256
HEX_DIGITS = 3
OVERSAMPLE = 20  # sampled keys for each bucket


def _search(df: DataFrame, points: Column, key: str, name: str, buckets: int) -> DataFrame:
    """Add the number of sorted ``points`` at or below ``key``: a binary search in log steps."""
    df = df.withColumn("_points", points).withColumn(name, F.lit(0))
    step = 1
    while step * 2 < buckets:
        step *= 2
    while step >= 1:
        below = F.get("_points", F.col(name) + (step - 1)) <= F.col(key)
        df = df.withColumn(name, F.col(name) + F.when(below, step).otherwise(0))
        step //= 2
    return df.drop("_points")


def split_points(keys: DataFrame, key: str, buckets: int = BUCKETS) -> Column:
    """At most ``buckets - 1`` sorted keys: every 20th of the keys with the smallest hashes.

    The hash order makes the sample the same on every run, so recomputed tasks agree. Skipping 19 of
    20 keeps the gaps between the points, and so the buckets, of similar size.
    """
    sample = keys.select(key).orderBy(F.xxhash64(key), key).limit(OVERSAMPLE * (buckets - 1))
    ordered = F.sort_array(F.collect_set(key))
    step = F.ceil(F.size(ordered) / (buckets - 1)).cast("int")
    places = F.sequence(F.lit(0), F.size(ordered) - 1, F.greatest(step, F.lit(1)))
    picked = F.when(F.size(ordered) > 0, F.transform(places, lambda i: F.get(ordered, i)))
    return sample.agg(F.coalesce(picked, ordered)).scalar()


def add_offsets(cut: DataFrame, order: Sequence[str], weight: str, groups: Sequence[str]) -> DataFrame:
    """Add ``before`` and the group's ``total`` to rows that carry their ``_bucket``.

    Windows run over one bucket of one group, and over the bucket totals of one group.
    """
    groups = list(groups)
    inside = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = cut.groupBy(*groups, "_bucket").agg(F.sum(weight).alias("_total"))
    whole = Window.partitionBy(*groups)
    offsets = totals.select(
        *[F.col(g).alias(f"_{g}") for g in groups],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_total").over(whole).alias("total"),
    )
    # Null-safe, so that no null filter is put below the shuffle that both sides can share.
    same = F.col("_bucket").eqNullSafe(F.col("_b"))
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return (
        cut.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(offsets, same)
        .withColumn("before", F.col("_inside") + F.col("_offset"))
        .drop("_bucket", "_b", "_offset", "_inside", *[f"_{g}" for g in groups])
    )


def running_before(keys: DataFrame, key: str, weight: str, buckets: int = BUCKETS) -> DataFrame:
    """Add ``before``: the total weight of the smaller keys. One row per key is expected.

    ``keys`` is read several times, so it should be a written table. ``buckets`` bounds the share
    of the keys that one task orders, and may grow with the cluster.
    """
    cut = _search(keys, split_points(keys, key, buckets), key, "_bucket", buckets)
    return add_offsets(cut, [key], weight, []).drop("total")


def dense_index(df: DataFrame, key: str) -> DataFrame:
    """``key, code, n``: zero-based alphabetical position of each value, and its row count."""
    values = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    values = materialize(values.withColumn("_one", F.lit(1)), "keys")
    return running_before(values, key, "_one").select(key, F.col("before").alias("code"), "n")


def ordered_within(df: DataFrame, group: str, key: str, digits: int = HEX_DIGITS) -> DataFrame:
    """``group, key, position, n``: place of each distinct key in its group, in hash order.

    The order is by the md5 of the key text, then by the key; ``n`` is the number of distinct
    keys of the group. The first hex digits of the hash are buckets of equal size.
    """
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    cut = df.select(group, key).distinct().select(
        group,
        key,
        digest.alias("_hash"),
        F.conv(F.substring(digest, 1, digits), 16, 10).cast("int").alias("_bucket"),
        F.lit(1).alias("_one"),
    )
    placed = add_offsets(cut, ["_hash", key], "_one", [group])
    return placed.select(group, key, F.col("before").alias("position"), F.col("total").alias("n"))


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """One row, one array ``q``: exact quantiles with linear interpolation."""
    values = (
        df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    return value_quantiles(materialize(values, "values"), "_v", "_n", probabilities)


def value_quantiles(values: DataFrame, value: str, n: str, probabilities: Sequence[float]) -> DataFrame:
    """Quantiles from a written table with one row per distinct value and its count."""
    placed = running_before(values, value, n).withColumn("_rows", values.agg(F.sum(n)).scalar())
    picks = []
    for i, p in enumerate(probabilities):
        rank = (F.col("_rows") - 1) * F.lit(float(p))
        for name, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            here = (F.col("before") <= at) & (at < F.col("before") + F.col(n))
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"{name}{i}"))
    row = placed.agg(F.max("_rows").alias("_rows"), *picks)
    ranks = [(F.col("_rows") - 1) * F.lit(float(p)) for p in probabilities]
    return row.select(
        F.array(
            *[
                F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (r - F.floor(r))
                for i, r in enumerate(ranks)
            ]
        ).alias("q")
    )
