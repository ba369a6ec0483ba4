"""Venue, year and author features of records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.records import year_norm
from ..functions.text import presence_flag, split_authors
from ..session import materialize
from .ordering import dense_index
from .skew import lookup_join

# The names of the features.
SCALED = (
    "venue_encoded", "year_norm", "author_count",
    "author_freq_mean", "author_freq_max", "author_freq_min",
)
FLAGS = ("has_abstract", "has_authors")


def narrow_records(df: DataFrame) -> DataFrame:
    """What the features need of each record, written once, since fitting reads it several times.

    Of the abstract only whether there is one is kept.
    """
    some = F.when(presence_flag("abstract") == 1, "+").alias("abstract")
    return materialize(df.select("id", "venue", "year", "authors", some), "records")


def record_authors(df: DataFrame, id_col: str = "id") -> DataFrame:
    """``id, author``: one row per name on a record."""
    return df.select(F.col(id_col).alias("id"), F.explode(split_authors("authors")).alias("author"))


def author_frequency(df: DataFrame) -> DataFrame:
    """``author, freq``: occurrences of each name."""
    return record_authors(df).groupBy("author").agg(F.count("*").alias("freq"))


def _freq_stats() -> list[Column]:
    """Aggregates over the names of a record; an unseen name counts as 0, no name gives 0."""
    freq = F.when(F.col("author").isNotNull(), F.coalesce("freq", F.lit(0)))
    return [
        F.count("author").cast("double").alias("author_count"),
        F.coalesce(F.avg(freq), F.lit(0.0)).alias("author_freq_mean"),
        F.coalesce(F.max(freq), F.lit(0)).cast("double").alias("author_freq_max"),
        F.coalesce(F.min(freq), F.lit(0)).cast("double").alias("author_freq_min"),
    ]


def author_stats(df: DataFrame, frequency: DataFrame) -> DataFrame:
    """Author count and mean/max/min frequency per record."""
    names = df.select("id", F.explode_outer(split_authors("authors")).alias("author"))
    return lookup_join(names, frequency, "author", "freq", "id").groupBy("id").agg(*_freq_stats())


def venue_index(df: DataFrame) -> DataFrame:
    """``venue, code, n``: alphabetical code of each venue; null counts as ``unknown``."""
    return dense_index(df.select(_venue()), "venue")


def _venue() -> Column:
    return F.coalesce("venue", F.lit("unknown")).alias("venue")


def scaler_stats(df: DataFrame, columns: Sequence[str] = SCALED) -> DataFrame:
    """One row: mean and population deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
    )


def minmax_stats(df: DataFrame, columns: Sequence[str] = SCALED) -> DataFrame:
    return df.agg(
        *[F.min(c).alias(f"{c}_min") for c in columns],
        *[F.max(c).alias(f"{c}_max") for c in columns],
    )


def standardise(df: DataFrame, stats: DataFrame, columns: Sequence[str] = SCALED) -> DataFrame:
    """(x - mean) / deviation with the given one-row statistics; a constant column is centred."""
    with_stats = df.withColumn("_s", stats.agg(F.first(F.struct(*stats.columns))).scalar())
    scaled = {}
    for c in columns:
        deviation = F.col(f"_s.{c}_std")
        scaled[c] = (F.col(c) - F.col(f"_s.{c}_mean")) / F.when(deviation == 0, 1.0).otherwise(
            deviation
        )
    return with_stats.withColumns(scaled).drop("_s")


@dataclass(frozen=True)
class MetadataState:
    """What is learned from the training records: three tables."""

    venues: DataFrame
    frequency: DataFrame
    stats: DataFrame


def raw_metadata(df: DataFrame, venues: DataFrame, frequency: DataFrame) -> DataFrame:
    """The eight features before scaling.

    One chain: look up the venue, unfold the names, look up the names, fold per record. A venue
    the index does not have gets code -1.
    """
    rows = df.select(
        "id",
        _venue(),
        year_norm("year").alias("year_norm"),
        presence_flag("abstract").cast("double").alias("has_abstract"),
        split_authors("authors").alias("names"),
    )
    coded = lookup_join(rows, venues, "venue", "n", "id").select(
        "id", "year_norm", "has_abstract",
        F.coalesce("code", F.lit(-1)).cast("double").alias("venue_encoded"),
        F.explode_outer("names").alias("author"),
    )
    own = ("venue_encoded", "year_norm", "has_abstract")
    folded = lookup_join(coded, frequency, "author", "freq", "id").groupBy("id").agg(
        *[F.max(c).alias(c) for c in own], *_freq_stats()
    )
    has_authors = (F.col("author_count") > 0).cast("double").alias("has_authors")
    return folded.select("id", *SCALED, "has_abstract", has_authors)


def fit_metadata(train: DataFrame) -> MetadataState:
    """Learn the tables; each is written once, since both fitting and applying read them."""
    venues = materialize(venue_index(train), "venues")
    frequency = materialize(author_frequency(train), "authors")
    return MetadataState(venues, frequency, scaler_stats(raw_metadata(train, venues, frequency)))


def metadata_features(df: DataFrame, state: MetadataState) -> DataFrame:
    """Eight features per record, the first six standardised with the training statistics."""
    return standardise(raw_metadata(df, state.venues, state.frequency), state.stats)

