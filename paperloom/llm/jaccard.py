"""Near-duplicate join: pairs of texts whose sets of five-word shingles have Jaccard >= 0.8.

1. Texts with the same words in the same order are one *class*; everything below is per class.
2. Each class gets ``BANDS * ROWS`` MinHash values. Classes that agree on all rows of a band share a
   bucket; a pair at the threshold misses all buckets with a probability below 1e-7. Buckets that
   hold the same classes are kept once.
3. Inside a bucket, pairs are compared a few MinHash values at a time. With a uniform prior, the
   posterior probability that the pair reaches the threshold follows from the agreements so far;
   a pair is dropped once it falls below ``TOLERANCE``. What remains is reported as a spanning forest,
   not as all pairs, and its connected components are the *groups*.
4. The shingle sets of a group's classes are brought together, the pairs go through the same
   pruning, and the rest is verified exactly. Counted links are summed per class; a spanning forest
   of the exact links gives the final components.

No task gets an unbounded group: a bucket or group above a fixed weight is dealt into blocks by hash,
and each pair of blocks is one task. The pairs themselves never become rows.

Defined results: null texts and texts without a word link to nothing and are a class of their own
row; a text of one to four words is one shingle; equal texts have one class and are no links;
null ids are allowed, and a class without any id has class id null; an empty table gives no rows.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import text_function, whole
from .components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-7
BUCKET_BLOCK = 512  # classes
GROUP_BLOCK = 200_000  # shingles
CLASS_WEIGHT = 400  # shingles
CELL = 8192  # distinct shingles multiplied at a time

_random = np.random.default_rng(20_240_501)
FACTORS = _random.integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _random.integers(0, 1 << 62, BANDS * ROWS, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> tuple[bytes, np.ndarray]:
    """A 128-bit digest of the words in order, and the sorted 64-bit codes of the shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # at ASCII space only
    if not words:
        return b"", np.zeros(0, np.uint64)
    digest = xxhash.xxh3_128_digest(b" ".join(words))
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(WORDS, len(words))
    out = codes[:len(codes) - n + 1].copy()
    for k in range(1, n):
        out = (out ^ (out >> np.uint64(31))) * MIX + codes[k:len(codes) - n + 1 + k]
    return digest, np.unique(out)


def signature(codes: np.ndarray) -> np.ndarray:
    out = np.full(len(FACTORS), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(codes), 2048):
        part = codes[at:at + 2048, None] * FACTORS + ADDENDS
        out = np.minimum(out, (part >> np.uint64(32)).min(axis=0))
    return out.astype(np.uint32)


def band_numbers(sig: np.ndarray) -> list[int]:
    """One number per band; it depends on the band and all its rows."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * MIX
    for k in range(ROWS):
        out = (out ^ (out >> np.uint64(29)) ^ rows[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
    return (out ^ (out >> np.uint64(32))).view(np.int64).tolist()


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of values compared, the fewest agreements that keep a pair.

    With a uniform prior, ``m`` agreements of ``n`` give a Beta(m + 1, n - m + 1) posterior, whose
    tail above the threshold is a binomial sum.
    """
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        tail, m = 0.0, 0
        while True:
            tail += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return out


LEAST = least_agreements()


def surviving(a: np.ndarray, b: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Which of the allowed pairs of rows of two signature tables are never pruned."""
    left, right = np.nonzero(allowed)
    agreed = np.zeros(len(left), np.int32)
    for k, least in enumerate(LEAST):
        if not len(left):
            break
        part = slice(k * STEP, (k + 1) * STEP)
        for at in range(0, len(left), 1 << 16):
            some = slice(at, at + (1 << 16))
            agreed[some] += (a[left[some], part] == b[right[some], part]).sum(axis=1, dtype=np.int32)
        keep = agreed >= least
        left, right, agreed = left[keep], right[keep], agreed[keep]
    return np.stack([left, right], axis=1)


def exact(pairs: np.ndarray, a: dict[int, np.ndarray], b: dict[int, np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """Of the pairs, those whose shingle sets reach the threshold."""
    if len(pairs) < 64:
        good = []
        for i, j in pairs.tolist():
            # Sets differ too much in size, or are counted in full.
            x, y = a[i], b[j]
            if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= threshold * (len(x) + len(y) - both):
                good.append((i, j))
        return np.array(good, np.int64).reshape(-1, 2)
    rows, columns = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
    x, y = [a[i] for i in rows], [b[j] for j in columns]
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y))
    common = np.zeros((len(x), len(y)), np.float64)

    def incidence(sets: list[np.ndarray], values: np.ndarray) -> np.ndarray:
        out = np.zeros((len(sets), len(values)), np.float32)
        for r, s in enumerate(sets):
            s = s[np.searchsorted(s, values[0]):np.searchsorted(s, values[-1], "right")]
            at = np.searchsorted(values, s)
            out[r, at[values[np.minimum(at, len(values) - 1)] == s]] = 1
        return out

    for at in range(0, len(shared), CELL):
        values = shared[at:at + CELL]
        common += incidence(x, values) @ incidence(y, values).T
    sizes_x, sizes_y = np.array([len(s) for s in x]), np.array([len(s) for s in y])
    linked = common >= threshold * (sizes_x[:, None] + sizes_y[None, :] - common)
    keep = linked[np.searchsorted(rows, pairs[:, 0]), np.searchsorted(columns, pairs[:, 1])]
    return pairs[keep]


def forest(pairs: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between the nodes ``a[i]`` and ``b[j]``."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in pairs.tolist():
        x, y = int(a[i]), int(b[j])
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def dealt(members: DataFrame, block: int) -> DataFrame:
    """Deal the members of groups (``g, node, weight``) to tasks of bounded weight.

    Groups up to ``block`` are packed together by hash. A larger one is cut into blocks by the hash
    of the node, and each pair of blocks is a task: ``task, i, j, side`` say which blocks the task
    compares and in which of the two this member is. Weights are summed before any row is moved.
    """
    totals = members.groupBy("g").agg(F.sum("weight").alias("total"))
    all_weight = totals.agg(F.sum("total")).first()[0] or 0
    bins = int(all_weight // block) + 1
    n = F.ceil(F.col("total") / block).cast("int")
    cut = members.join(totals, "g").withColumn("n", n).withColumn(
        "own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("n")).cast("int"))
    pair = F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")
    cut = cut.select("*", pair).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    task = F.when(F.col("n") == 1, F.pmod(F.xxhash64("g"), F.lit(bins))).otherwise(F.xxhash64("g", "i", "j"))
    return cut.withColumns({"task": task, "side": (F.col("own") != F.col("i")).cast("int")}).drop(
        "total", "n", "own", "other")


def compare(rows: pd.DataFrame, verify: bool, threshold: float) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Forest edges and numbers of links of one task, group by group."""
    g, i, j, side, node, size = (rows[c].to_numpy() for c in ("g", "i", "j", "side", "node", "size"))
    order = np.lexsort((node, side, j, i, g))
    sigs = np.frombuffer(b"".join(rows["sig"]), np.uint32).reshape(len(rows), BANDS * ROWS)
    sets = rows["codes"].tolist() if verify else None
    cell = np.stack([g[order], i[order], j[order]])
    starts = np.flatnonzero(np.append(True, (cell[:, 1:] != cell[:, :-1]).any(axis=0)))
    edges: list[tuple[int, int]] = []
    links: dict[int, int] = {}
    for low, high in zip(starts, np.append(starts[1:], len(order))):
        part = order[low:high]
        same = i[part[0]] == j[part[0]]
        left, right = (part, part) if same else (part[side[part] == 0], part[side[part] == 1])
        if not len(left) or not len(right):
            continue
        x, y = size[left][:, None], size[right][None, :]
        allowed = np.minimum(x, y) >= threshold * np.maximum(x, y)
        if same:
            allowed = np.triu(allowed, 1)
        pairs = surviving(sigs[left], sigs[right], allowed)
        if verify and len(pairs):
            pairs = exact(pairs, *[{k: np.frombuffer(sets[t[k]], np.uint64) for k in np.unique(pairs[:, c]).tolist()}
                                   for c, t in enumerate((left, right))], threshold)
            ends, n = np.unique(np.concatenate([node[left[pairs[:, 0]]], node[right[pairs[:, 1]]]]), return_counts=True)
            for end, count in zip(ends.tolist(), n.tolist()):
                links[end] = links.get(end, 0) + count
        edges += forest(pairs, node[left], node[right])
    return edges, links


MARKED = pa.struct([("node", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])
MARKED_DDL = "struct<node:long,n:long,sig:binary,bands:array<long>>"


def mark(texts: list[str | None]) -> list[dict]:
    out = []
    for text in texts:
        digest, codes = shingles(text)
        row: dict = {"node": None, "n": 0, "sig": None, "bands": None}
        if len(codes):
            sig = signature(codes)
            row = {"node": int.from_bytes(digest[:8], "little", signed=True), "n": len(codes), "sig": sig.tobytes(),
                   "bands": band_numbers(sig)}
        out.append(row)
    return out


def candidates(lone: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b``: links between classes that share a bucket and outlive the pruning, as forests."""
    slots = lone.select("node", F.explode("bands").alias("band"))
    buckets = slots.groupBy("band").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"))
    # Buckets of the same classes have the same count and hash sum; one of them is enough.
    buckets = buckets.where(F.col("n") > 1).groupBy("n", "s").agg(F.min("band").alias("band"))
    members = slots.join(buckets.select("band"), "band").select(
        F.col("band").alias("g"), "node", F.lit(1).alias("weight"))
    tasks = dealt(materialize(members, "buckets"), BUCKET_BLOCK).join(lone.select("node", "size", "sig"), "node")

    def prune(rows: pd.DataFrame) -> pd.DataFrame:
        edges, _ = compare(rows, False, threshold)
        return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")

    return tasks.groupBy("task").applyInPandas(prune, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Two written tables.

    ``rows`` has ``id, whole, node`` of every document: the hash of its text, and its class, null
    for texts without words. ``classes`` has ``node, copy_id, root, class_id, n_links``: the smallest
    id with the same words, the component and the smallest id in it, and the number of different
    texts linked to this one. ``node`` is 64 bits of the digest of the words.
    """
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"),
                         F.xxhash64(text).alias("whole"))
    marked = text_function(mark, MARKED_DDL, MARKED)
    rows = materialize(source.select("id", "whole", marked("text").alias("k")).select("id", "whole", "k.*"), "signatures")
    # Copies agree in all that follows from the words; they are put together before the shuffle.
    lone = materialize(
        rows.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("id").alias("copy_id"), F.min("n").alias("size"), F.first("sig").alias("sig"),
            F.first("bands").alias("bands")), "classes")
    groups = components(candidates(lone, threshold))

    # The shingle sets of the classes that stand in a group, from one text of each.
    wanted = materialize(groups.join(lone, "node").select("node", F.col("root").alias("g"), "size", "copy_id", "sig"), "groups")
    one = (
        rows.select("id", "whole", "node").join(wanted.select("node", "copy_id"), "node")
        .where(F.col("id").eqNullSafe(F.col("copy_id")))
        .groupBy("node").agg(F.first("id").alias("one_id"), F.min("whole").alias("one_whole"))
    )
    codes = text_function(lambda texts: [shingles(t)[1].tobytes() for t in texts], "binary", pa.binary())
    chosen = (
        source.join(one, source["id"].eqNullSafe(one["one_id"]) & (source["whole"] == one["one_whole"]))
        .select("node", codes("text").alias("codes")).dropDuplicates(["node"])
    )
    # A class counts for some hundred shingles at least, which bounds the pairs of a task.
    grouped = wanted.select("node", "g", "size", "sig", (F.col("size") + CLASS_WEIGHT).alias("weight")).join(chosen, "node")

    def verify(part: pd.DataFrame) -> pd.DataFrame:
        edges, links = compare(part, True, threshold)
        # A count is a loop with a number: a missing end would turn long numbers into floats.
        out = [(a, b, 0) for a, b in edges] + [(node, node, n) for node, n in links.items()]
        return pd.DataFrame(out, columns=["a", "b", "n"]).astype("int64")

    verified = dealt(materialize(grouped, "sets"), GROUP_BLOCK).groupBy("task").applyInPandas(
        verify, "a long, b long, n long")
    verified = materialize(verified, "links")
    counts = verified.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    roots = components(verified.where("n = 0"))
    classes = lone.select("node", "copy_id").join(roots, "node", "left").join(counts, "node", "left").select(
        "node", "copy_id", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    classes = materialize(classes, "classes")
    least = classes.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    classes = materialize(classes.join(least, "root"), "classes")
    return rows.select("id", "whole", "node"), classes


def members(docs: DataFrame, **options) -> DataFrame:
    """``id, class_id, copy_id, n_links``: one row per document."""
    rows, classes = near_duplicates(docs, **options)
    joined = rows.join(classes, "node", "left")
    return joined.select(
        "id", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """The documents, one of each connected group; texts without words all stay.

    The smallest id stays, of equal ids the smallest hash of the text, of equal rows any. The group's
    choice is made on narrow rows; only rows that occur several times are put together whole.
    """
    rows, classes = near_duplicates(docs, id_col=id_col, text_col=text_col, threshold=threshold)
    placed = rows.join(classes.select("node", "root"), "node", "left")
    worded = placed.where(F.col("node").isNotNull())
    # Null ids come last.
    order = F.struct(F.col("id").isNull().alias("late"), F.col("id").alias("id"), F.col("whole").alias("whole"))
    stay = worded.groupBy("root").agg(F.min(order).alias("o")).select("root", "o.id", "o.whole")
    again = worded.groupBy("id", "whole").agg(F.count("*").alias("n"))
    empty = placed.where(F.col("node").isNull()).select("id", "whole").distinct()
    stay = stay.select("id", "whole").join(again, ["id", "whole"], "left")  # null ids get no count
    nulls = again.where(F.col("id").isNull()).select(F.col("whole").alias("null_whole"), F.col("n").alias("null_n"))
    stay = stay.join(nulls, F.col("id").isNull() & (F.col("whole") == F.col("null_whole")), "left")
    stay = stay.select(F.col("id").alias("stay_id"), F.col("whole").alias("stay_whole"),
                       F.coalesce("n", "null_n").alias("n"))
    stay = stay.union(empty.select("id", "whole", F.lit(1)))
    stay = materialize(stay, "stay")
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(whole(docs).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"),
                         F.xxhash64(text).alias("whole"))
    kept = source.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("whole") == F.col("stay_whole")))
    single = kept.where(F.col("n") == 1).select("row")
    several = kept.where(F.col("n") > 1).groupBy("stay_id", "stay_whole").agg(F.first("row").alias("row")).select("row")
    return single.union(several).select("row.*")
