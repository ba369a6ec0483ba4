"""Exact nearest neighbours by cosine distance, and the distance-weighted vote.

The two vector sets are never paired as a whole. Vectors are brought to unit length, where
cosine order equals Euclidean order, and each reference vector goes to the cell of its nearest
pivot. The triangle inequality tells which cells can hold a neighbour of a query, so a query
is sent to those cells only. Cells and query groups are cut into blocks of bounded size; one
task compares one block of references with one block of queries and emits the k best per query.

This is the published pivot-based scheme for kNN joins (Lu et al., VLDB 2012), written as Spark
shuffles. All bounds are exact: the result equals the full comparison.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialize

BLOCK = 4096
MAX_PIVOTS = 1024
DIGITS = 9  # distances are rounded, so equal vectors tie and ties break by id
NOISE = 1e-7  # error of a Euclidean distance taken from a cosine


def _unit(vectors: pd.Series, zero_axis: int) -> np.ndarray:
    """Rows of unit length with two extra axes.

    A zero vector has cosine 0 to everything. It becomes a unit vector on an axis of its own,
    one for references and one for queries.
    """
    raw = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    out = np.zeros((raw.shape[0], raw.shape[1] + 2))
    norm = np.sqrt((raw * raw).sum(axis=1))
    some = norm > 0
    out[some, :-2] = raw[some] / norm[some, None]
    out[~some, zero_axis] = 1.0
    return out


REFERENCE, QUERY = -2, -1


def _euclid(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def smallest_copies(df: DataFrame, k: int) -> DataFrame:
    """At most k rows per identical vector, those with the smallest ids.

    Exact, since equal distances are ordered by id: a further copy can never be among the k
    nearest. Spark limits the groups before the shuffle, so a mass of copies stays small.
    """
    order = Window.partitionBy("embedding").orderBy("id")
    return df.withColumn("_nr", F.row_number().over(order)).where(F.col("_nr") <= k).drop("_nr")


def pick_pivots(reference: DataFrame, pivots: int) -> np.ndarray:
    """A bounded, repeatable sample of reference vectors."""
    rows = reference.orderBy(F.xxhash64("id"), "id").limit(pivots).select("embedding").collect()
    if not rows:
        return np.zeros((0, 0))
    return _unit(pd.Series([r[0] for r in rows]), REFERENCE)


def knn_join(queries: DataFrame, reference: DataFrame, k: int = 5, pivots: int | None = None,
             block: int = BLOCK) -> DataFrame:
    """``id, neighbour_id, distance, rank`` for frames ``id, embedding``: the k nearest each.

    The placed references and the routed queries are written once, as both are read again.
    What comes to the driver (pivots, cell sizes, queries per cell) is bounded by the number of
    pivots, not by the data.
    """
    queries = queries.select("id", "embedding")
    reference = materialize(smallest_copies(reference.select("id", "embedding"), k), "reference")
    if pivots is None:
        pivots = min(MAX_PIVOTS, math.ceil(4 * reference.count() / block))
    points = pick_pivots(reference, pivots)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    if len(points) == 0:
        return queries.sparkSession.createDataFrame(
            [], f"id {queries.schema['id'].dataType.simpleString()}, neighbour_id long, distance double, rank int"
        )

    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                d = _euclid(_unit(pdf["embedding"], REFERENCE), points)
                yield pdf.assign(cell=d.argmin(axis=1).astype("int32"), r=d.min(axis=1))

    placed = materialize(reference.mapInPandas(to_cell, schema + ", cell int, r double"), "placed")

    near = Window.partitionBy("cell").orderBy("r", "id")
    closest = (
        placed.select("cell", "r", "id").withColumn("nr", F.row_number().over(near))
        .where(F.col("nr") <= k).groupBy("cell").agg(F.sort_array(F.collect_list("r")).alias("near"))
    )
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("far"))
    cells = sizes.join(closest, "cell").collect()  # at most one row per pivot

    far = np.full(len(points), -1.0)
    slices = np.zeros(len(points), dtype=np.int64)
    bound = np.full((len(points), k), np.inf)
    for c in cells:
        far[c["cell"]] = c["far"]
        slices[c["cell"]] = math.ceil(c["n"] / block)
        bound[c["cell"], : len(c["near"])] = c["near"]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            d = _euclid(_unit(pdf["embedding"], QUERY), points)
            # No query is further from its k-th neighbour than from the k-th of these.
            reach = np.empty(len(pdf))
            for i in range(len(pdf)):
                known = (d[i][:, None] + bound).ravel()
                reach[i] = np.partition(known, k - 1)[k - 1] if known.size >= k else np.inf
            # Compared as cosine distances, one rounding step wider, so that no neighbour and
            # no tie is lost to rounding.
            nearest = np.maximum(0.0, d - far - NOISE) ** 2 / 2
            limit = (reach[:, None] + NOISE) ** 2 / 2 + 2 * 10.0**-DIGITS
            needed = (far >= 0) & (nearest <= limit)
            yield pdf.assign(cells=[np.flatnonzero(n).astype("int32") for n in needed])

    routed = materialize(queries.mapInPandas(route, schema + ", cells array<int>"), "routed")
    visits = routed.select("id", "embedding", F.explode("cells").alias("cell"))
    load = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    groups = [math.ceil(load.get(c, 0) / block) for c in range(len(points))]

    # A cell of s slices and its g query groups give s * g tasks, each of bounded size.
    n_slices = F.array(*[F.lit(int(max(s, 1))) for s in slices])
    n_groups = F.array(*[F.lit(int(max(g, 1))) for g in groups])

    def spread(df: DataFrame, own: str, own_n, other: str, other_n) -> DataFrame:
        return df.select(
            "id", "embedding", "cell",
            F.pmod(F.xxhash64("id"), own_n[F.col("cell")]).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), other_n[F.col("cell")] - 1)).alias(other),
        )

    left = spread(visits, "grp", n_groups, "slice", n_slices)
    right = spread(placed, "slice", n_slices, "grp", n_groups)
    id_type = queries.schema["id"].dataType.simpleString()

    def compare(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"id": [], "neighbour_id": [], "distance": []})
        reference_ids = r["id"].to_numpy()
        by_id = np.argsort(reference_ids, kind="stable")
        reference_ids = reference_ids[by_id]
        unit = _unit(r["embedding"], REFERENCE)[by_id]
        similarity = _unit(q["embedding"], QUERY) @ unit.T
        # Rounded distance first, then place in id order: one number per pair, without ties.
        n = len(reference_ids)
        order = np.rint((1.0 - similarity) * 10.0**DIGITS).astype("int64") * n + np.arange(n)
        if n > k:
            order = np.partition(order, k - 1, axis=1)[:, :k]
        order.sort(axis=1)
        return pd.DataFrame({
            "id": np.repeat(q["id"].to_numpy(), order.shape[1]),
            "neighbour_id": reference_ids[(order % n).ravel()],
            "distance": (order // n).ravel() / 10.0**DIGITS,
        })

    keys = ("cell", "slice", "grp")
    partial = (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInPandas(compare, f"id {id_type}, neighbour_id {id_type}, distance double")
    )
    best = Window.partitionBy("id").orderBy("distance", "neighbour_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def knn_vote(neighbours: DataFrame, labels: DataFrame, reference_id: str = "id") -> DataFrame:
    """``id, prediction``: labels weighted by 1/distance; neighbours at distance 0 decide alone.

    Of equal weights the lowest label wins.
    """
    named = labels.select(F.col(reference_id).alias("neighbour_id"), F.col("label").alias("_label"))
    voted = neighbours.join(named, "neighbour_id")
    per_label = voted.groupBy("id", "_label").agg(
        F.count_if(F.col("distance") <= 0).cast("double").alias("exact"),
        F.sum(F.when(F.col("distance") > 0, 1 / F.col("distance")).otherwise(0.0)).alias("inverse"),
    )
    # ``exact`` compares first: when any neighbour is at 0, only such neighbours count.
    exact_first = F.struct(
        F.col("exact"),
        F.when(F.col("exact") > 0, 0.0).otherwise(F.round("inverse", 6)),
        -F.col("_label"),
    )
    return per_label.groupBy("id").agg(F.max_by("_label", exact_first).alias("prediction"))


def knn_classifier(train: DataFrame, test: DataFrame, k: int = 5) -> DataFrame:
    """``id, prediction`` for the test vectors from ``id, embedding, label`` training rows."""
    return knn_vote(knn_join(test, train, k), train)
