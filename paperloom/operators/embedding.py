"""Dense vectors learned from term weights: a truncated singular value decomposition by block power iteration.

A block of ``size`` + ``EXTRA`` directions over the vocabulary goes to every task. Each task multiplies its
sparse rows with the block and back, and the products are summed by term in one aggregation: that is one
step of the power iteration, after which the block is made orthonormal again. The block has as many rows as
the vocabulary, which must be bounded; the number of records does not matter. A record's vector is its row
times the directions found, of unit length, or zeros where it has none of the terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from .stages import _WithParts

EXTRA = 16
MOST_TERMS = 100_000
PART = 1 << 15  # entries that are multiplied with the block at a time


def sparse_parts(vector: str) -> tuple[Column, Column]:
    """Indices and values of a vector column, sparse or dense."""
    plain = F.unwrap_udt(vector)
    values = plain["values"]
    dense = F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(plain["indices"], dense), values


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def _products(at: pa.Array, values: pa.Array, block: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By parts of a batch: which rows, the rows, indices and values of their entries, and the rows times the block.

    One direction after the other, so that what is read for the entries is one column of the block, which stays in the cache;
    the block should be in column order.
    """
    ends = at.offsets.to_numpy() - at.offsets[0].as_py()
    index_all = at.flatten().to_numpy(zero_copy_only=False)
    weight_all = values.flatten().to_numpy(zero_copy_only=False)
    start = 0
    while start < len(at):
        # One long row, or as many as fit the entries of a part.
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + PART, "right")) - 1)
        rows = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1]))
        index, weight = index_all[ends[start]:ends[stop]].astype(np.intp), weight_all[ends[start]:ends[stop]]
        out = np.zeros((stop - start, block.shape[1]), order="F")
        used = np.flatnonzero(np.diff(ends[start:stop + 1]))
        first = ends[start:stop][used] - ends[start]
        for k, direction in enumerate(block.T if len(used) else ()):
            out[used, k] = np.add.reduceat(direction.take(index) * weight, first)
        yield slice(start, stop), rows, index, weight, out
        start = stop


class LatentTerms(Estimator, _WithParts):
    """Fits on a vector column of term weights; the model adds ``outputCol``, an array of ``size`` numbers."""

    def __init__(self, inputCol: str, outputCol: str = "embedding", size: int = 64, steps: int = 30, tolerance: float = 1e-8, seed: int = 42):
        super().__init__()
        self.inputCol, self.outputCol, self.size, self.steps, self.tolerance, self.seed = inputCol, outputCol, size, steps, tolerance, seed

    def settings(self) -> dict:
        return {k: getattr(self, k) for k in ("inputCol", "outputCol", "size", "steps", "tolerance", "seed")}

    def save_parts(self, folder: str) -> None:
        """Everything is in the settings."""

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> LatentTerms:
        return cls(**settings)

    def _fit(self, df: DataFrame) -> LatentTermsModel:
        at, values = sparse_parts(self.inputCol)
        width = df.select(F.max(F.coalesce(F.unwrap_udt(self.inputCol)["size"], F.size(values)))).first()[0] or 0
        if width > MOST_TERMS:
            raise ValueError(f"more than {MOST_TERMS} terms; limit the vocabulary")
        if not width:
            return LatentTermsModel(np.zeros((0, self.size)), np.zeros(self.size), self.inputCol, self.outputCol)
        rows = materialize(df.select(at.alias("at"), values.alias("values")).where(F.size("at") > 0), "latent")
        count = min(self.size + EXTRA, width)
        block, _ = np.linalg.qr(np.random.default_rng(self.seed).normal(size=(width, count)))
        before = np.zeros(count)
        for _ in range(self.steps):
            product = self._step(rows, block, width)
            block, triangle = np.linalg.qr(product)
            # The squares of the singular values within the block.
            found = np.sort(np.linalg.svd(triangle, compute_uv=False))[::-1]
            kept = min(self.size, count)
            if np.abs(found[:kept] - before[:kept]).max() <= self.tolerance * max(found[0], 1e-300):
                break
            before = found
        square = block.T @ self._step(rows, block, width)
        values_, turn = np.linalg.eigh((square + square.T) / 2)
        order = np.argsort(-values_)[:self.size]
        directions = block @ turn[:, order]
        # A direction's sign is free; its largest entry is made positive.
        directions *= np.sign(directions[np.abs(directions).argmax(axis=0), range(len(order))])
        return LatentTermsModel(directions, np.sqrt(np.maximum(values_[order], 0.0)), self.inputCol, self.outputCol)

    def _step(self, rows: DataFrame, block: np.ndarray, width: int) -> np.ndarray:
        """The rows' transpose times the rows times the block."""
        shared = rows.sparkSession.sparkContext.broadcast(block)
        kind = pa.schema([("term", pa.int32()), ("sums", pa.list_(pa.float64()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block_ = np.asfortranarray(shared.value)
            total = np.zeros(block_.T.shape)
            for batch in batches:
                for _, row, index, weight, out in _products(batch.column(0), batch.column(1), block_):
                    # Of a wide block only the terms that are there.
                    terms, at = (slice(None), index) if width <= PART else np.unique(index, return_inverse=True)
                    for k, said in enumerate(out.T):
                        total[k, terms] += np.bincount(at, said.take(row) * weight, width if width <= PART else len(terms))
            used = np.flatnonzero(np.abs(total).sum(axis=0))
            for start in range(0, len(used), 1000):
                part = used[start:start + 1000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), _lists(total[:, part].T).cast(kind.field(1).type)], schema=kind)

        sums = rows.mapInArrow(run, "term int, sums array<double>").groupBy("term").agg(
            F.array(*[F.sum(F.col("sums")[k]) for k in range(block.shape[1])]).alias("sums"))
        product = np.zeros((width, block.shape[1]))
        for part in sums.toArrow().to_batches():  # one row for each term of the bounded vocabulary
            product[part.column(0).to_numpy()] = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
        shared.unpersist()
        return product


class LatentTermsModel(Model, _WithParts):
    def __init__(self, directions: np.ndarray, singular: np.ndarray, inputCol: str, outputCol: str):
        super().__init__()
        self.directions, self.singular, self.inputCol, self.outputCol = directions, singular, inputCol, outputCol

    def settings(self) -> dict:
        return {"singular": self.singular.tolist(), "inputCol": self.inputCol, "outputCol": self.outputCol}

    def save_parts(self, folder: str) -> None:
        rows = [(k, d.tolist()) for k, d in enumerate(self.directions)]
        SparkSession.active().createDataFrame(rows, "term int, direction array<double>").write.mode("overwrite").parquet(f"{folder}/directions")

    @classmethod
    def from_parts(cls, spark: SparkSession, folder: str, settings: dict) -> LatentTermsModel:
        rows = spark.read.parquet(f"{folder}/directions").orderBy("term").collect()  # the bounded vocabulary
        directions = np.array([r["direction"] for r in rows]).reshape(len(rows), len(settings["singular"]))
        return cls(directions, np.array(settings["singular"]), settings["inputCol"], settings["outputCol"])

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.directions)
        size = len(self.singular)

        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            directions = np.asfortranarray(shared.value)
            for at, values in batches:
                out = np.zeros((len(at), size))
                if len(directions):
                    for part, *_, known in _products(at, values, directions):
                        out[part, :known.shape[1]] = known
                length = np.sqrt((out * out).sum(axis=1, keepdims=True))
                out /= np.where(length > 0, length, 1.0)
                yield _lists(out)

        embed = F.arrow_udf(run, "array<double>", F.ArrowUDFType.SCALAR_ITER)
        return df.withColumn(self.outputCol, embed(*sparse_parts(self.inputCol)))
