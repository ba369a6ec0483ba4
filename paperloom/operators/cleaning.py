"""Merging, filling and normalising record tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import core, records, text

REQUIRED = ("title", "abstract", "authors")
HELPERS = ("crawled_authors", "source")


def drop_columns(df: DataFrame, names: Iterable[str] = (), containing: str | None = None) -> DataFrame:
    """Drop the listed columns if present, and every column whose name contains a text."""
    gone = [c for c in df.columns if c in set(names) or (containing and containing in c)]
    return df.drop(*gone)


def ensure_columns(df: DataFrame, names: Iterable[str] = REQUIRED) -> DataFrame:
    missing = [c for c in names if c not in df.columns]
    return df.withColumns({c: F.lit("") for c in missing}) if missing else df


def fill_missing(df: DataFrame) -> DataFrame:
    """Blank texts for null, ``unknown`` venue, integer year with 0 for what is no number."""
    df = ensure_columns(df)
    fills = {c: core.safe_text(c) for c in REQUIRED}
    if "venue" in df.columns:
        fills["venue"] = F.coalesce(F.col("venue"), F.lit("unknown"))
    if "year" in df.columns:
        fills["year"] = records.year_int("year")
    return df.withColumns(fills)


def normalize_authors(df: DataFrame) -> DataFrame:
    return df.withColumn("authors", text.normalize_author_list("authors"))


def clean_texts(df: DataFrame, columns: Iterable[str] = ("title", "abstract")) -> DataFrame:
    return df.withColumns({c: text.clean_text(c) for c in columns if c in df.columns})


def clean_records(df: DataFrame) -> DataFrame:
    """Fill, normalise authors, clean texts: one narrow pass, also on a streaming frame."""
    return clean_texts(normalize_authors(fill_missing(df)))


def conditional_update(df: DataFrame, column: str, when: Column, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(when, value).otherwise(F.col(column)))


def enrich_left_join(base: DataFrame, crawl: DataFrame, key: str = "id") -> DataFrame:
    """Left join on the key; a crawl column that clashes gets the suffix ``_crawl``."""
    renames: Mapping[str, str] = {
        c: f"{c}_crawl" for c in crawl.columns if c != key and c in base.columns
    }
    return base.join(crawl.withColumnsRenamed(renames), key, "left")


def enrich_coalesce(merged: DataFrame) -> DataFrame:
    """Own abstract and authors first, crawled ones where they are missing or blank."""
    out = merged
    if "abstract" in out.columns:
        own = core.blank_to_null("abstract")
        other = [F.col("abstract_crawl")] if "abstract_crawl" in out.columns else []
        out = out.withColumn("abstract", F.coalesce(own, *other))
    if "crawled_authors" in out.columns:
        out = conditional_update(
            out, "authors", core.is_blank("authors"), F.col("crawled_authors")
        )
    return drop_columns(out, containing="_crawl")


def merge_records(base: DataFrame, crawl: DataFrame) -> DataFrame:
    return drop_columns(enrich_coalesce(enrich_left_join(base, crawl)), HELPERS)


def union_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """Stack both splits; a column that only one of them has is null in the other."""
    return train.unionByName(test, allowMissingColumns=True)


def label_attach(df: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    return df.join(labels, key)


def unmatched(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Keys that only one side has, with that side; empty when the two tables fit together."""
    only_left = left.select(key).join(right.select(key), key, "left_anti")
    only_right = right.select(key).join(left.select(key), key, "left_anti")
    return only_left.withColumn("side", F.lit("left")).unionByName(
        only_right.withColumn("side", F.lit("right"))
    )
