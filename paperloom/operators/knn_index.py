"""Approximate nearest neighbours by cosine: inverted lists with residual codes, checked against the exact way.

Centroids and the range of the residuals are fitted on a bounded sample of different vectors; every row is then
indexed: it goes to the list of its nearest centroid with a code of one byte per entry for what the
centroid leaves over. A query looks into the lists of its ``probes`` nearest centroids, cut into blocks so that
a long list is many tasks, keeps the best ``refine`` candidates by their codes and ranks them again by the
exact distance. ``calibrated_probes`` finds how many lists are needed, from exact neighbours of some queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.vectors import cosine_distance
from ..session import materialize
from .knn import knn_join

CELLS = 32
SAMPLE = 20_000  # different vectors that the centroids are fitted on
BLOCK, GROUP = 1024, 256  # rows of a list, and queries, that meet in one step
PAIRS = 32  # blocks with their queries that a Python worker gets at a time
REFINE = 50


@dataclass(frozen=True)
class Index:
    """Centroids, the largest residual of each entry, the written lists and their lengths in blocks."""

    centroids: np.ndarray
    scale: np.ndarray
    lists: DataFrame  # cell, block, id, code
    blocks: DataFrame  # cell, n_blocks; one row for each centroid


def _rows(batch: pa.Array) -> np.ndarray:
    """Unit rows; a zero vector stays zero."""
    x = batch.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(batch), -1)
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1.0)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Cells of each row, nearest first."""
    return np.argsort((centroids * centroids).sum(axis=1) - 2 * x @ centroids.T, axis=1, kind="stable")


def _by_size(df: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a part number of their cell, parts of about ``size`` rows; and the number of parts of each cell."""
    counts = materialize(df.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts")), f"{name}-cells")
    placed = df.join(F.broadcast(counts), "cell").withColumn(name, F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return placed.drop("parts"), counts.withColumnRenamed("parts", f"n_{name}s")


def build(reference: DataFrame, cells: int = CELLS, sample: int = SAMPLE, seed: int = 42) -> Index:
    """Index every row of ``id, embedding``."""
    vectors = reference.select(F.col("embedding").cast("array<double>").alias("x"))
    chosen = materialize(vectors.dropna().distinct().orderBy(F.xxhash64("x"), "x").limit(sample), "index-sample")

    def unit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_rows(batch).tolist() if len(batch) else [], pa.list_(pa.float64()))

    units = chosen.select(array_to_vector(F.arrow_udf(unit, "array<double>", F.ArrowUDFType.SCALAR_ITER)("x")).alias("features"))
    n = units.count()
    if not n:
        empty = reference.select(F.lit(0).alias("cell"), F.lit(0).alias("block"), "id", F.lit(b"").alias("code")).limit(0)
        return Index(np.zeros((0, 0)), np.zeros(0), empty, empty.groupBy("cell").agg(F.lit(0).alias("n_blocks")))
    fitted = KMeans(k=max(1, min(cells, n)), seed=seed, maxIter=20).fit(units)
    centroids = np.array(fitted.clusterCenters())
    points = np.array([r["features"].toArray() for r in units.collect()])  # the bounded sample
    scale = np.abs(points - centroids[_nearest(points, centroids)[:, 0]]).max(axis=0) * 1.25 + 1e-12
    kind = pa.struct([("cell", pa.int32()), ("code", pa.binary())])

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if not len(batch):
                yield pa.array([], kind)
                continue
            x = _rows(batch)
            cell = _nearest(x, centroids)[:, 0]
            code = np.clip(np.rint((x - centroids[cell]) / scale * 127), -127, 127).astype(np.int8)
            yield pa.StructArray.from_arrays([pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary())], fields=list(kind))

    coded = F.arrow_udf(encode, "struct<cell:int,code:binary>", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    table = reference.dropna(subset=["embedding"]).select("id", coded(F.col("embedding").cast("array<double>")).alias("c")).select("id", "c.*")
    lists, blocks = _by_size(materialize(table, "index-codes"), BLOCK, "block")
    return Index(centroids, scale, materialize(lists, "index-lists"), blocks)


def _routed(index: Index, queries: DataFrame, probes: int) -> DataFrame:
    """``id, x, cell, nr``: the nearest cells of each query, nearest first."""
    centroids = index.centroids

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_nearest(_rows(batch), centroids)[:, :probes].tolist() if len(batch) else [], pa.list_(pa.int32()))

    route = F.arrow_udf(run, "array<int>", F.ArrowUDFType.SCALAR_ITER).asNondeterministic()
    known = queries.dropna(subset=["embedding"]).select("id", F.col("embedding").cast("array<double>").alias("x"))
    return known.withColumn("cells", route("x")).select("id", "x", F.posexplode("cells").alias("nr", "cell"))


def candidates(index: Index, queries: DataFrame, probes: int, refine: int) -> DataFrame:
    """``id, neighbour_id``: the best of each query by the codes."""
    if not len(index.centroids):
        return queries.select("id", F.col("id").alias("neighbour_id")).limit(0)
    routed = materialize(_routed(index, queries, probes), "index-queries")
    grouped, _ = _by_size(routed, GROUP, "grp")
    left = grouped.groupBy("cell", "grp").agg(F.collect_list("id").alias("q"), F.collect_list("x").alias("x"))
    left = left.join(F.broadcast(index.blocks), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    right = index.lists.groupBy("cell", "block").agg(F.collect_list("id").alias("r"), F.collect_list("code").alias("codes"))
    both = left.join(right.hint("shuffle_hash"), ["cell", "block"])
    centroids, scale = index.centroids, index.scale
    id_kind, other_kind = (to_arrow_type(df.schema["id"].dataType) for df in (queries, index.lists))
    kind = pa.schema([("id", id_kind), ("neighbour_id", other_kind), ("near", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                cell = batch.column(0)[at].as_py()
                q, x, r, codes = (batch.column(k)[at].values for k in range(1, 5))
                rows = centroids[cell] + np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(len(r), -1) * (scale / 127)
                x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(q), -1)
                length = np.sqrt((x * x).sum(axis=1, keepdims=True))
                far = 1 - (x / np.where(length > 0, length, 1.0)) @ rows.T
                order = np.argsort(far, axis=1, kind="stable")[:, :refine]
                yield pa.RecordBatch.from_arrays([
                    q.take(pa.array(np.repeat(np.arange(len(q)), order.shape[1]))), r.take(pa.array(order.ravel())),
                    pa.array(np.take_along_axis(far, order, axis=1).ravel(), pa.float64())], schema=kind)

    ids = f"id {queries.schema['id'].dataType.simpleString()}, neighbour_id {index.lists.schema['id'].dataType.simpleString()}"
    # A row is a block of codes with a group of queries, some 200 KB. Spark's batch of 10,000 rows is made for narrow
    # ones; the setting is lowered for this step alone, and bounds memory only.
    spark, setting = queries.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(PAIRS))
    try:
        found = materialize(both.select("cell", "q", "x", "r", "codes").mapInArrow(compare, f"{ids}, near double"), "index-found")
    finally:
        spark.conf.set(setting, before)
    best = Window.partitionBy("id").orderBy("near", "neighbour_id")
    return found.withColumn("nr", F.row_number().over(best)).where(F.col("nr") <= refine).select("id", "neighbour_id")


def search(index: Index, queries: DataFrame, reference: DataFrame, k: int = 5, probes: int = 8, refine: int = REFINE) -> DataFrame:
    """``id, neighbour_id, distance, rank`` of the k nearest found, by exact distance (9 digits), then id.

    Ids are keys. Rows without a vector are neither queries nor neighbours; a vector of zeros is at distance 1 from all.
    """
    near = candidates(index, queries, probes, max(refine, k))
    other = reference.select(F.col("id").alias("neighbour_id"), F.col("embedding").alias("there"))
    both = near.join(queries.select("id", F.col("embedding").alias("here")), "id").join(other, "neighbour_id")
    exact = both.select("id", "neighbour_id", F.round(cosine_distance("here", "there"), 9).alias("distance"))
    order = Window.partitionBy("id").orderBy("distance", "neighbour_id")
    return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrated_probes(index: Index, queries: DataFrame, reference: DataFrame, k: int = 5, target: float = 0.95, sample: int = 200) -> int:
    """The least number of lists that hold the ``target`` share of the exact neighbours of about ``sample`` queries."""
    some = materialize(queries.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(sample), "index-probe")
    exact = knn_join(some, reference.select("id", "embedding"), k).select("id", "neighbour_id")
    cells = index.lists.select(F.col("id").alias("neighbour_id"), "cell")
    ranks = exact.join(cells, "neighbour_id").join(_routed(index, some, len(index.centroids)).select("id", "cell", "nr"), ["id", "cell"])
    counts = {r["nr"]: r["n"] for r in ranks.groupBy("nr").agg(F.count("*").alias("n")).collect()}
    total, held = sum(counts.values()), 0
    for nr in sorted(counts):
        held += counts[nr]
        if held >= target * total:
            return nr + 1
    return max(1, len(index.centroids))
