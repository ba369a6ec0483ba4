"""Search for the cut points that turn scores into labels.

The rows are read once, into a histogram of fixed size (labels x score bins). Every candidate
is then scored from cumulative counts, so the cost of the search does not depend on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import LABELS

STEP = 100  # bins per unit of score
LOW, HIGH = LABELS[0] * STEP, LABELS[-1] * STEP
NAMES = ("t1", "t2", "t3", "t4")


def score_histogram(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``label, bin, n``. Bin b holds scores in [b/100, (b+1)/100).

    Cut points lie between the lowest and the highest label, so everything below or above
    them can share one bin. Rows without a score or label are left out.
    """
    nr = F.greatest(F.lit(LOW - 1), F.least(F.lit(HIGH), F.floor(F.round(F.col(score) * STEP, 6))))
    scored = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return scored.groupBy(F.col(label).alias("label"), nr.cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )


def cumulative(histogram: DataFrame) -> DataFrame:
    """One row: per label an array with the rows below each bin border."""
    spark = histogram.sparkSession
    bins = F.sequence(F.lit(LOW - 1), F.lit(HIGH + 1))
    spine = spark.range(1).select(
        F.explode(F.array(*map(F.lit, LABELS))).alias("label"), bins.alias("bins")
    ).select("label", F.explode("bins").alias("bin"))
    before = Window.partitionBy("label").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    counted = spine.join(F.broadcast(histogram), ["label", "bin"], "left").select(
        "label", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below")
    )
    arrays = counted.groupBy("label").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("bin", "below"))), lambda x: x["below"]
        ).alias("below")
    )
    return arrays.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("label", "below"))), lambda x: x["below"]
        ).alias("below")
    )


def with_objective(candidates: DataFrame, below: Column, f1_weight: float = 0.4) -> DataFrame:
    """Add ``objective`` = weighted kappa and macro-F1 of each set of cut bins.

    The steps are separate projections, so each count is computed once per candidate.
    """
    k = len(LABELS)
    borders = [F.lit(LOW - 1), *[F.col(t) for t in NAMES], F.lit(HIGH + 1)]
    at = [b - F.lit(LOW - 1) for b in borders]
    df = candidates.withColumn("_below", below)
    cells = {
        f"c_{i}_{j}": (F.col("_below")[i][at[j + 1]] - F.col("_below")[i][at[j]]).cast("double")
        for i in range(k)
        for j in range(k)
    }
    df = df.withColumns(cells).drop("_below")

    def total(terms) -> Column:
        terms = list(terms)
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out

    df = df.withColumns(
        {
            **{f"truth_{i}": total(F.col(f"c_{i}_{j}") for j in range(k)) for i in range(k)},
            **{f"said_{j}": total(F.col(f"c_{i}_{j}") for i in range(k)) for j in range(k)},
            "gap": total(
                F.col(f"c_{i}_{j}") * ((i - j) ** 2) for i in range(k) for j in range(k) if i != j
            ),
        }
    )

    def moment(side: str, power: int) -> Column:
        return total(F.col(f"{side}_{i}") * (v**power) for i, v in enumerate(LABELS))

    df = df.withColumns(
        {
            "n": moment("truth", 0), "y": moment("truth", 1), "yy": moment("truth", 2),
            "p": moment("said", 1), "pp": moment("said", 2),
            **{f"seen_{i}": F.col(f"truth_{i}") + F.col(f"said_{i}") for i in range(k)},
        }
    )
    df = df.withColumn(
        "expected", F.col("n") * (F.col("yy") + F.col("pp")) - 2 * F.col("y") * F.col("p")
    )
    kappa = F.when(F.col("expected") != 0, 1 - F.col("n") * F.col("gap") / F.col("expected"))
    f1 = total(
        F.when(F.col(f"seen_{i}") > 0, 2 * F.col(f"c_{i}_{i}") / F.col(f"seen_{i}")).otherwise(0.0)
        for i in range(k)
    )
    present = total(F.when(F.col(f"seen_{i}") > 0, 1.0).otherwise(0.0) for i in range(k))
    mean_f1 = F.when(present > 0, f1 / present).otherwise(0.0)
    value = (1 - f1_weight) * F.coalesce(kappa, F.lit(0.0)) + f1_weight * mean_f1
    return df.select(*NAMES, F.round(value, 9).alias("objective"))


def coarse_candidates(spark, step: int) -> DataFrame:
    """All increasing sets of four cut bins on a grid from the lowest to the highest label."""
    last = (HIGH - LOW) // step
    grid = spark.range(0, last - 2).select(F.col("id").cast("int").alias("t1"))
    for nr, (prev, name) in enumerate(zip(NAMES, NAMES[1:])):
        stop = F.lit(last - 2 + nr)
        grid = grid.withColumn(name, F.explode(F.sequence(F.col(prev) + 1, stop)))
    return grid.select(*[(F.col(t) * step + LOW).alias(t) for t in NAMES])


def fine_candidates(best: DataFrame, reach: int) -> DataFrame:
    """Increasing sets with every cut within ``reach`` bins of the best coarse one."""
    out = best.select(*[F.col(t).alias(f"{t}_0") for t in NAMES])
    for t in NAMES:
        start = F.greatest(F.lit(LOW), F.col(f"{t}_0") - reach)
        stop = F.least(F.lit(HIGH), F.col(f"{t}_0") + reach)
        out = out.withColumn(t, F.explode(F.sequence(start, stop)))
    increasing = (F.col("t1") < F.col("t2")) & (F.col("t2") < F.col("t3")) & (F.col("t3") < F.col("t4"))
    return out.where(increasing).select(*NAMES)


def best_candidate(candidates: DataFrame, below: Column, f1_weight: float) -> DataFrame:
    """The set with the highest objective; of equal ones the lowest cuts."""
    scored = with_objective(candidates, below, f1_weight)
    lowest_first = F.struct("objective", *[(-F.col(t)).alias(f"m_{t}") for t in NAMES])
    return scored.agg(F.max_by(F.struct(*NAMES, "objective"), lowest_first).alias("b")).select("b.*")


def threshold_search(df: DataFrame, score: str = "score", label: str = "label",
                     f1_weight: float = 0.4, coarse_step: int = 10, reach: int = 5) -> DataFrame:
    """One row ``t1..t4, objective``: grid in tenths, then in hundredths around its best set."""
    below = cumulative(score_histogram(df, score, label)).scalar()
    spark = df.sparkSession
    coarse = best_candidate(coarse_candidates(spark, coarse_step), below, f1_weight)
    fine = best_candidate(fine_candidates(coarse, reach), below, f1_weight)
    return fine.select(*[(F.col(t) / float(STEP)).alias(t) for t in NAMES], "objective")
