"""What the text operators share: whole rows beside working columns, row keys, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The characters between words, as used by every word count here.
SPACE = "\\x20\\x09-\\x0D"
SLICE = 256  # rows turned into Python objects at a time
BATCH = 1_000  # rows of long texts that a Python worker gets at a time


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    """A table of long texts. Spark's default batch of 10,000 rows is made for narrow ones, so the
    session's setting is lowered; it bounds memory only and changes no result."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting)) > BATCH:
        spark.conf.set(setting, str(BATCH))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(df: DataFrame) -> Column:
    """Every column of a row as one struct, so that working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


FINE = 1 << 40


def in_share(value: Column, wanted: int, n: Column | int) -> Column:
    """Whether a hash lies in the share of about ``wanted`` of ``n`` hashes; never quite none."""
    rate = F.greatest(F.lit(1.0), F.lit(float(FINE * wanted)) / F.greatest(F.lit(1), n if isinstance(n, Column) else F.lit(n)))
    return F.pmod(value, F.lit(FINE)) < rate


def sampled_texts(rows: DataFrame, wanted: int) -> DataFrame:
    """About ``wanted`` different texts of each group, each once, for rows ``text`` and group columns.

    Copies are counted once, so one text with very many copies neither crowds out the others nor
    breaks the bound. Only hashes are shuffled for the count.
    """
    by = [c for c in rows.columns if c != "text"]
    hashed = rows.where(F.col("text").isNotNull()).withColumn("_hash", F.xxhash64("text"))
    sizes = hashed.select(*by, "_hash").distinct().groupBy(*by).agg(F.count("*").alias("n")).collect()
    share = F.lit(0)
    for r in sizes:
        own = F.lit(True)
        for c in by:
            own = own & F.col(c).eqNullSafe(F.lit(r[c]))
        share = F.when(own, r["n"]).otherwise(share)
    chosen = hashed.where(in_share(F.col("_hash"), wanted, share))
    return chosen.groupBy(*by, "_hash").agg(F.min("text").alias("text")).drop("_hash")


def text_function(fn: Callable[[list], list], ddl: str, kind: pa.DataType, rows: int = SLICE):
    """A function on a text column from one on lists of texts; the other columns stay in the JVM.

    It counts as not deterministic only so that the optimizer never runs it twice for a row.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = [pa.array(fn(batch.slice(at, rows).to_pylist()), kind)
                    for at in range(0, len(batch), rows)]
            yield pa.concat_arrays(done) if done else pa.array([], kind)
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, ddl, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def columns_function(fn: Callable[..., list], ddl: str, kind: pa.DataType, rows: int = SLICE):
    """As ``text_function``, for a function on the values of several columns."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            n = len(batch[0])
            done = [pa.array(fn(*[c.slice(at, rows).to_pylist() for c in batch]), kind) for at in range(0, n, rows)]
            yield pa.concat_arrays(done) if done else pa.array([], kind)

    return F.arrow_udf(run, ddl, F.ArrowUDFType.SCALAR_ITER).asNondeterministic()


def _fold_table(letters_only: bool) -> np.ndarray:
    """For each code unit below 2**16 its lower-case form, and a space for what separates words."""
    table = np.full(1 << 16, 32, np.uint16)
    for code in range(1 << 16):
        char = chr(code)
        if char.isalpha() or not letters_only and char.isalnum():
            table[code] = ord(char.lower()[0])
    table[-1] = 0xFFFF  # all characters beyond are one letter
    return table


FOLD = {flag: _fold_table(flag) for flag in (False, True)}


def folded(text: str, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters and digits with single spaces between, and their places in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    chars = FOLD[letters_only][np.minimum(codes, 0xFFFF)]
    keep = chars != 32
    keep[1:] |= keep[:-1].copy()  # one space after each run
    places = np.flatnonzero(keep)
    if len(places) and chars[places[-1]] == 32:
        places = places[:-1]
    return chars[places].astype(np.uint64), places
