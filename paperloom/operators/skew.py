"""Equi-joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEAVY_SHARE = 1000
SALTS = 64


def _is_heavy(n: str) -> Column:
    return F.col(n) * HEAVY_SHARE >= F.col("_total")


def lookup_join(rows: DataFrame, table: DataFrame, key: str, n: str, spread_by: str,
                how: str = "left", salts: int = SALTS, strategy: str | None = None) -> DataFrame:
    """Join ``rows`` to a table with one row per ``key``; heavy keys are spread over ``salts``.

    Column ``n`` of the table says how often the key occurs. A key with at least 1/1000 of the
    total is heavy, so there are never more than 1000 heavy keys: only these are broadcast, as
    markers, and copied in the table. All other keys take the plain shuffle with salt 0. Null
    keys match nothing and are spread too. ``strategy`` is a join hint for a table that grows with the
    rows, however small it is in a run. ``n`` only steers the spreading; a wrong count costs
    time, not rows.
    """
    counted = table.withColumn("_total", table.agg(F.sum(n)).scalar())
    heavy = counted.where(_is_heavy(n)).select(key, F.lit(True).alias("_heavy"))
    hot = F.coalesce(F.col("_heavy"), F.col(key).isNull())
    salt = F.when(hot, F.pmod(F.xxhash64(spread_by), F.lit(salts))).otherwise(F.lit(0))
    left = (
        rows.join(F.broadcast(heavy), key, "left")
        .withColumn("_salt", salt.cast("int"))
        .drop("_heavy")
    )
    copies = F.when(_is_heavy(n), F.sequence(F.lit(0), F.lit(salts - 1)))
    right = counted.withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    right = right.drop("_total")
    return left.join(right.hint(strategy) if strategy else right, [key, "_salt"], how).drop("_salt")
