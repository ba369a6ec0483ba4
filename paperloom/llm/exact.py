"""Exact deduplication by a 128-bit content hash, with bytes compared inside the groups.

Texts are equal when they are identical after lower-casing A-Z. Rows are grouped by the MD5 of that
form, and of equal texts the row with the largest id stays. The hash decides nothing by itself: the
texts are also grouped by hash and bytes, and where one hash holds different bytes its texts are told
apart by their SHA-256 as well, which the same comparison checks. All of it is plain DataFrame work.

Grouping is by aggregates that are combined before the shuffle, so a group of copies that holds a third
of all rows arrives as one row per task. The way back from groups to rows joins the groups that hold more
than a thousandth of the rows (never more than a thousand) by broadcast, and all others by a shuffle.

Defined results: a null text is equal to an empty one; null ids come before all others, so such a row
stays only where no copy has an id; of rows with the same text and the same id exactly one stays; texts
of any length count whole; an empty table gives no rows. Columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import whole

HEAVY = 1000


def normal_form(text: Column) -> Column:
    """The text in lower case as far as A-Z goes; null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def content_hash(normal: Column) -> Column:
    return F.unhex(F.md5(normal.cast("binary")))


def _numbered(docs: DataFrame, id_col: str, text_col: str, key: Callable[[Column], Column]) -> DataFrame:
    """``id, nr, key, sha`` of every row, written once so that the row numbers hold from here on."""
    normal = normal_form(F.col(f"`{text_col}`"))
    return materialize(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("nr"), key(normal).alias("key"),
        F.unhex(F.sha2(normal.cast("binary"), 256)).alias("sha")), "hashes")


def collisions(docs: DataFrame, *, text_col: str = "text", key: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``key, n_texts, n_hashes`` of each hash that different texts share, found by comparing bytes."""
    normal = normal_form(F.col(f"`{text_col}`"))
    texts = docs.select(key(normal).alias("key"), normal.alias("normal")).groupBy("key", "normal").agg(F.lit(1).alias("one"))
    per_key = texts.groupBy("key").agg(F.count("*").alias("n_texts"), F.count_distinct(F.sha2(F.col("normal").cast("binary"), 256)).alias("n_hashes"))
    return per_key.where(F.col("n_texts") > 1)


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           key: Callable[[Column], Column] = content_hash) -> DataFrame:
    """``id, nr, keep_id, group_size, kept, sha`` of every row; ``nr`` is any number of the row's own."""
    rows = _numbered(docs, id_col, text_col, key)
    shared = collisions(docs, text_col=text_col, key=key)
    found = materialize(shared, "collisions")
    by = ["key"]
    if not found.isEmpty():
        if not found.where(F.col("n_texts") != F.col("n_hashes")).isEmpty():
            raise ValueError("different texts share both hashes")
        by = ["key", "sha"]
    last = F.max(F.struct("id", "nr"))
    sizes = materialize(rows.groupBy(*by).agg(last.alias("last"), F.count("*").alias("group_size")), "groups")
    total = sizes.agg(F.coalesce(F.sum("group_size"), F.lit(0)).alias("n")).first()["n"]
    heavy = F.broadcast(sizes.where(F.col("group_size") * HEAVY >= total))  # at most HEAVY rows
    light = sizes.where(F.col("group_size") * HEAVY < total)
    joined = rows.join(heavy, by).unionByName(rows.join(heavy.select(*by), by, "left_anti").join(light, by))
    return joined.select("id", "nr", F.col("last.id").alias("keep_id"), "group_size",
                         (F.col("nr") == F.col("last.nr")).alias("kept"), "sha")


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Of rows alike in text and id, one in the order of a hash."""
    kept = groups(docs, id_col=id_col, text_col=text_col).where("kept").select("id", "sha")
    normal = normal_form(F.col(f"`{text_col}`"))
    source = docs.select(whole(docs).alias("row"), F.col(f"`{id_col}`").alias("id"),
                         F.unhex(F.sha2(normal.cast("binary"), 256)).alias("sha"))
    # Ids that differ for one text never match here; equal ones are combined before the shuffle.
    one = source.groupBy("sha", "id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    same = one["sha"].eqNullSafe(kept["sha"]) & one["id"].eqNullSafe(kept["id"])
    return one.join(kept, same, "left_semi").select("row.*")
