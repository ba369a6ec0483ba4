"""Connected components of a graph given as an edge table, by rounds of star contraction.

Each round first links every larger neighbour of a node to the smallest of its neighbourhood, then
every smaller one, until all edges lead to the smallest node of their component. A round is two
aggregations and two joins on whole tables, which Spark combines before the shuffle and splits where
one node has most edges; its result is written to the shared folder, so the plan stays short and a
lost executor costs one round. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize

MAX_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge to another one; ``root`` is the smallest.

    Nodes are long numbers. Null ends, loops and repeated edges are ignored.
    """
    u, v = F.col(f"`{a}`").cast("long"), F.col(f"`{b}`").cast("long")
    stars = materialize(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges")
    before = _state(stars)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = stars.union(stars.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("w").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("w"))
        small = large.join(least, "u").where(F.col("v") != F.col("w")).select(F.col("v").alias("u"), F.col("w").alias("v"))
        small = small.union(least.select("u", F.col("w").alias("v"))).where(F.col("u") != F.col("v"))
        stars = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        after = _state(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
