"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

The targets share all tokens by weight, but no source gives more than ``MOST`` times its size; what
is over is shared again by weight until no target is above. The tokens of the mix are blocks of
``BLOCK`` words. Sources get integer numbers of blocks by the highest quotients ``t / (2 k + 1)``;
the shards of a source, which are bounded parts of it by hash, get theirs in the same way. Inside a
shard the documents stand in the order of a seeded hash and are cut into blocks; a quota is met by
whole rounds over all blocks and then by the blocks with the smallest seeded hashes. The same input
gives the same mix.

One row per source travels to the driver. Documents are counted and placed as narrow rows; equal
rows are counted before they are moved and then dealt out one by one, so a third of all rows may be
equal. A shard holds about ``SHARD_WORDS`` words, whatever the size of its source.

Defined results: a null text has no words, and such a document is never taken; a null source is a
source of its own and the last one; repeated rows are documents of their own; an empty table gives
no rows. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize
from .common import columns_function, text_function, whole

# The weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 32  # words
SHARD_WORDS = 4_000_000
SEED = 17


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST) -> list[float]:
    """The tokens each source should give; together all tokens, none above ``most`` times its size."""
    out = [0.0] * len(sizes)
    free = [i for i, size in enumerate(sizes) if size > 0]
    rest = float(sum(sizes))
    while free:
        unit = rest / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in over:
            out[i] = float(most * sizes[i])
            rest -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def apportion(shares: Sequence[float], seats: int) -> list[int]:
    """Seats by the highest quotients ``share / (2 k + 1)``; of equal ones the first.

    All quotients above a divisor are counted at once; only the last seats are given one by one.
    """
    total = float(sum(shares))
    if total <= 0 or seats <= 0:
        return [0] * len(shares)
    # The largest divisor's inverse that gives no more than the seats, by bisection.
    low, high = 0.0, 2 * (seats + len(shares)) / total
    for _ in range(100):
        middle = (low + high) / 2
        if sum(int(s * middle + 0.5) for s in shares) <= seats:
            low = middle
        else:
            high = middle
    given = [int(s * low + 0.5) for s in shares]
    heap = [(-s / (2 * g + 1), i) for i, (s, g) in enumerate(zip(shares, given)) if s > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heap[0]
        given[i] += 1
        heapq.heapreplace(heap, (-shares[i] / (2 * given[i] + 1), i))
    return given


def word_count(texts: list[str | None]) -> list[int]:
    return [len((t or "").encode("utf-8", "surrogatepass").split()) for t in texts]  # at ASCII space only


def spread(*values: int | np.ndarray) -> np.ndarray:
    """A 64-bit hash of numbers, for seeded order."""
    out = np.uint64(0x9E3779B97F4A7C15)
    for v in values:
        out = (out ^ np.atleast_1d(np.asarray(v, np.int64)).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out = out ^ (out >> np.uint64(29))
    return out


def taken_ranges(sizes: np.ndarray, quota: int, seed: int, block: int = BLOCK) -> tuple[int, list[list[tuple[int, int]]]]:
    """Whole rounds over all documents, and the ranges of words taken once more from each."""
    ends = np.cumsum(sizes)
    n = -(-int(ends[-1]) // block)
    # The last block may be short, so the rounds are measured in words.
    rounds, left = divmod(min(quota * block, MOST * int(ends[-1])), int(ends[-1]))
    rest = min(n, round(left / block))
    order = np.lexsort((np.arange(n), spread(seed, np.arange(n))))
    chosen = np.zeros(n + 1, bool)
    chosen[order[:rest]] = True
    # Neighbouring blocks are one range.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], chosen]).astype(np.int8)))
    low, high = edges[::2] * block, np.minimum(edges[1::2] * block, ends[-1])
    out = []
    for start, end in zip((ends - sizes).tolist(), ends.tolist()):
        first, last = np.searchsorted(high, start, "right"), np.searchsorted(low, end, "left")
        out.append([(max(int(a), start) - start, min(int(b), end) - start)
                    for a, b in zip(low[first:last], high[first:last])])
    return rounds, out


def shard_quotas(cells: DataFrame) -> DataFrame:
    """``quota`` of each shard: the blocks of its source by the highest quotients among its shards.

    Rounding each share gives the seats above a common divisor. The few that are missing or too many
    go by the next or last quotients, ranked per source over narrow rows, one per shard.
    """
    share = F.col("blocks") * F.col("words") / F.col("source_size")
    cells = cells.withColumn("base", F.floor(share + 0.5))
    by_source = Window.partitionBy("source_no")
    cells = cells.withColumn("missing", F.col("blocks") - F.sum("base").over(by_source))
    more = F.col("missing") > 0
    steps = F.ceil(F.abs("missing") * F.col("words") / F.col("source_size")).cast("int") + 1
    next_seats = cells.where("missing != 0").withColumn("k", F.explode(F.sequence(F.lit(0), steps)))
    quotient = F.when(more, F.col("words") / (2 * (F.col("base") + F.col("k")) + 1)).otherwise(
        -F.col("words") / (2 * (F.col("base") - F.col("k")) - 1))
    next_seats = next_seats.where(more | (F.col("base") > F.col("k"))).withColumn("quotient", quotient)
    order = Window.partitionBy("source_no").orderBy(F.desc("quotient"), "shard")
    change = (
        next_seats.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.abs("missing"))
        .groupBy("source_no", "shard").agg(F.sum(F.signum("missing")).cast("long").alias("change"))
    )
    quota = F.col("base") + F.coalesce("change", F.lit(0))
    return cells.join(change, ["source_no", "shard"], "left").select("source_no", "shard", quota.alias("quota"))


RANGES_DDL = "array<struct<start:long,stop:long>>"


def mix_plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[float] = WEIGHTS, block: int = BLOCK, seed: int = SEED,
             row_hash: Column | None = None) -> DataFrame:
    """One row per document: ``id, hash, copies, size, source_size, target, rounds, ranges, taken``.

    The document is taken ``rounds`` times whole, and once more the words in ``ranges`` (places
    among its words, stop exclusive). ``hash`` stands for the row (the text and source, if no other
    is given); ``copies`` counts the rows equal to it, which have a plan each.
    """
    spark = docs.sparkSession
    text, source = F.col(f"`{text_col}`").cast("string"), F.col(f"`{source_col}`").cast("string")
    hashed = F.xxhash64(text, source) if row_hash is None else row_hash
    counted = text_function(word_count, "long", pa.int64())
    sized = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), source.alias("source"), hashed.alias("hash"),
                        counted(text).alias("size"))
    sized = materialize(sized.groupBy("id", "source", "hash", "size").agg(F.count("*").alias("copies")), "sizes")
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()
    totals = sorted(((r["source"], r["n"]) for r in totals), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in totals]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    quotas = apportion(wanted, round(sum(sizes) / block))
    table = spark.createDataFrame(
        [(i, name, n, t, q, n // SHARD_WORDS + 1) for i, ((name, n), t, q) in enumerate(zip(totals, wanted, quotas))],
        "source_no int, name string, source_size long, target double, blocks long, shards long")
    # Equal rows become rows of their own again only after they were counted.
    each = sized.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    each = each.join(table, F.col("source").eqNullSafe(F.col("name"))).drop("name", "source")
    place = F.xxhash64("id", "hash", "copy", F.lit(seed))
    each = each.withColumn("place", place).withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")))
    worded = each.where(F.col("size") > 0)
    cells = worded.groupBy("source_no", "shard", "source_size", "blocks").agg(F.sum("size").alias("words"))
    placed = worded.join(materialize(shard_quotas(cells), "quotas"), ["source_no", "shard"])

    def choose(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["place", "id", "hash"], na_position="first").reset_index(drop=True)
        salt = int(spread(seed, int(cell["source_no"].iat[0]), int(cell["shard"].iat[0])).astype(np.int64)[0])
        rounds, ranges = taken_ranges(cell["size"].to_numpy(), int(cell["quota"].iat[0]), salt, block)
        cell["rounds"] = rounds
        cell["ranges"] = [[{"start": a, "stop": b} for a, b in r] for r in ranges]
        cell["taken"] = cell["size"] * rounds + np.array([sum(b - a for a, b in r) for r in ranges], np.int64)
        return cell[PLAN]

    narrow = placed.select("id", "hash", "copies", "size", "source_size", "target", "source_no", "shard", "place", "quota")
    plan = narrow.groupBy("source_no", "shard").applyInPandas(choose, PLAN_DDL)
    never = each.where(F.col("size") == 0).select(
        "id", "hash", "copies", "size", "source_size", "target", F.lit(0).cast("long").alias("rounds"),
        F.array().cast(RANGES_DDL).alias("ranges"), F.lit(0).cast("long").alias("taken"))
    return plan.union(never)


PLAN = ["id", "hash", "copies", "size", "source_size", "target", "rounds", "ranges", "taken"]
PLAN_DDL = (f"id long, hash long, copies long, size long, source_size long, target double, rounds long, "
            f"ranges {RANGES_DDL}, taken long")


def cut_words(texts: list[str | None], ranges: list[list[dict]]) -> list[str]:
    """The words of the ranges as they stand in the text, ranges joined by a space."""
    out = []
    for text, parts in zip(texts, ranges):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        at, ends = 0, []
        for word in words:
            at = raw.index(word, at) + len(word)
            ends.append(at)
        pieces = [raw[ends[p["start"]] - len(words[p["start"]]):ends[p["stop"] - 1]] for p in parts]
        out.append(b" ".join(pieces).decode("utf-8", "surrogatepass"))
    return out


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          **options) -> DataFrame:
    """The documents of the mix with their own columns: whole ones as often as planned, and the
    words taken once more as a shortened text of the same document."""
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    plan = mix_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, row_hash=every, **options)
    plan = materialize(plan.where(F.col("taken") > 0), "mix")
    source = docs.select(whole(docs).alias("row"), F.col(f"`{id_col}`").cast("long").alias("row_id"), every.alias("row_hash"))
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("hash"))
    plan = plan.select("id", "hash", "copies", "rounds", "ranges")
    single = source.join(plan.where("copies = 1"), same).select("row", "rounds", "ranges")
    # Equal rows are put together once and then joined with the plan of each.
    several = source.join(plan.where("copies > 1").select("id", "hash").distinct(), same)
    several = several.groupBy("row_id", "row_hash").agg(F.first("row").alias("row"))
    several = several.join(plan.where("copies > 1"), same).select("row", "rounds", "ranges")
    out = single.union(several)
    full = out.where("rounds > 0").select("row", F.explode(F.sequence(F.lit(1), "rounds"))).select("row.*")
    cut = columns_function(cut_words, "string", pa.string())
    part = out.where(F.size("ranges") > 0).select("row", cut(F.col("row")[text_col].cast("string"), F.col("ranges")).alias("part"))
    part = part.select(F.col("row").withField(f"`{text_col}`", F.col("part")).alias("row")).select("row.*")
    return full.union(part)
