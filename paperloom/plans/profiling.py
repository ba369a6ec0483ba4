"""Profiles of record tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L, text as T
from ..functions.core import WORD
from ..operators import folds, profile
from ..sources import io, tables
from . import sql as Q
from .registry import query
from .sql import with_views

COLUMNS = ["id", "title", "abstract", "venue", "year", "doi", "authors"]
TEXT_COLUMNS = COLUMNS[1:]


@query("null_counts", with_views(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM papers" for c in COLUMNS),
    "papers"))
def null_counts(spark, sf):
    return profile.null_counts(tables.papers(spark, sf).select(*COLUMNS))


@query("missing_report", with_views(
    """SELECT "column", count(*) FILTER (gap) AS missing_count,
      round(count(*) FILTER (gap) / count(*) * 100, 2) AS missing_ratio FROM gaps
      GROUP BY "column" HAVING count(*) FILTER (gap) > 0""", "papers",
    gaps=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {Q.blank(c)} AS gap FROM papers" for c in TEXT_COLUMNS)))
def missing_report(spark, sf):
    return profile.missing_report(tables.papers(spark, sf).select(*COLUMNS))


@query("missing_ids", with_views(
    " UNION ALL ".join(
        f"SELECT id, '{c}' AS \"column\" FROM papers WHERE {Q.blank(c)}" for c in TEXT_COLUMNS), "papers"))
def missing_ids(spark, sf):
    return profile.missing_ids(tables.papers(spark, sf).select(*COLUMNS))


@query("value_counts", with_views(
    "SELECT label, count(*) AS n FROM labelled GROUP BY label", "labelled"))
def value_counts(spark, sf):
    return profile.value_counts(tables.labelled(spark, sf), "label")


@query("unique_counts", with_views(
    "SELECT year, count(*) AS n FROM papers_meta WHERE year IS NOT NULL GROUP BY year", "papers_meta"))
def unique_counts(spark, sf):
    years = io.load_table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return profile.value_counts(years, "year")


@query("distinct_labels", with_views("SELECT DISTINCT label FROM labelled ORDER BY label", "labelled"))
def distinct_labels(spark, sf):
    return tables.labelled(spark, sf).select("label").distinct().orderBy("label")


DUP_KEYS = {"id": ["id"], "title": ["title"], "doi": ["doi"], "abstract": ["abstract"], "row": None}


@query("dup_count", with_views(
    " UNION ALL ".join(
        f"SELECT '{name}' AS key, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM "
        f"(SELECT count(*) AS n FROM dup_input GROUP BY {', '.join(keys) if keys else 'ALL'})"
        if keys else
        f"SELECT '{name}', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM dup_input "
        "GROUP BY id, title, doi, abstract)"
        for name, keys in DUP_KEYS.items()),
    "paper_texts", dup_input="SELECT id, title, doi, abstract FROM paper_texts"))
def dup_count(spark, sf):
    rows = tables.paper_texts(spark, sf).select("id", "title", "doi", "abstract")
    return profile.dup_counts(rows, DUP_KEYS)


@query("dup_rows", """
    SELECT conv_id, turn, role FROM conversations
    WHERE conv_id IN (SELECT conv_id FROM conversations GROUP BY conv_id HAVING count(*) > 1) ORDER BY conv_id""")
def dup_rows(spark, sf):
    rows = io.load_table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return profile.dup_rows(rows, "conv_id").orderBy("conv_id", "turn")


AUTHOR_COUNTS = "SELECT len(string_split(coalesce(authors, 'nan'), ',')) AS n FROM papers_meta_authors"


@query("describe", with_views(
    """SELECT count(n) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
      CAST(min(n) AS INTEGER) AS min, quantile_cont(n, 0.25) AS q25, quantile_cont(n, 0.5) AS q50,
      quantile_cont(n, 0.75) AS q75, CAST(max(n) AS INTEGER) AS max FROM counts""",
    "papers_meta_authors", counts=AUTHOR_COUNTS))
def describe(spark, sf):
    counts = tables.papers_authors(spark, sf).select(T.author_count_raw("authors").alias("n"))
    return profile.describe(counts, "n").withColumns(
        {"mean": F.round("mean", 6), "std": F.round("std", 6)})


def _histogram_sql(source: str) -> str:
    return f"""SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (b.bin - 1) * (hi - lo) / 20, 6) AS low,
        round(lo + b.bin * (hi - lo) / 20, 6) AS high, count(x) AS n
      FROM range(1, 21) b(bin) CROSS JOIN (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM {source}) m
      LEFT JOIN {source} s ON least(20, floor((s.x - lo) / ((hi - lo) / 20)) + 1) = b.bin
      GROUP BY b.bin, lo, hi"""


def _rounded_histogram(df, column):
    return profile.histogram(df, column).withColumns(
        {"low": F.round("low", 6), "high": F.round("high", 6)})


@query("histogram", with_views(_histogram_sql("years"), "papers_meta",
                               years="SELECT year AS x FROM papers_meta WHERE year IS NOT NULL"))
def histogram(spark, sf):
    years = io.load_table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"))
    return _rounded_histogram(years, "year")


@query("histogram_authors", with_views(
    _histogram_sql("sizes"), "papers_meta_authors", counts=AUTHOR_COUNTS, sizes="SELECT n AS x FROM counts"))
def histogram_authors(spark, sf):
    counts = tables.papers_authors(spark, sf).select(T.author_count_raw("authors").alias("n"))
    return _rounded_histogram(counts, "n")


@query("length_stats", with_views(
    """SELECT count(*) AS n, round(avg(len), 6) AS mean, quantile_cont(len, 0.5) AS median,
      CAST(max(len) AS INTEGER) AS max_len, round(quantile_cont(len, 0.95), 6) AS p95,
      round(quantile_cont(len, 0.99), 6) AS p99 FROM lengths""", "papers",
    lengths=r"""SELECT len(regexp_extract_all('venue: ' || coalesce(venue, '') || ' year: ' || coalesce(year, '')
      || ' authors: ' || coalesce(authors, '') || ' ' || title || ' ( ' || coalesce(venue, '') || ' ) [SEP] '
      || coalesce(abstract, ''), '[\p{L}\p{N}_]+')) AS len FROM papers"""))
def length_stats(spark, sf):
    prompt = T.prompt_venue("venue", "year", "authors", "title", "abstract")
    length = F.size(F.regexp_extract_all(prompt, F.lit(f"[{WORD}]+"), F.lit(0)))
    stats = profile.length_stats(tables.papers(spark, sf), length)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "p95", "p99")})


@query("label_share", with_views(
    """SELECT label, n, round(n / (sum(n) OVER ()) * 100, 2) AS pct,
      round(max(n) OVER () / min(n) OVER (), 6) AS imbalance
      FROM (SELECT label, count(*) AS n FROM paper_texts GROUP BY label)""", "paper_texts"))
def label_share(spark, sf):
    shares = profile.label_share(tables.paper_texts(spark, sf))
    return shares.withColumn("imbalance", F.round("imbalance", 6))


@query("pct_round", """
    SELECT source, round(count(*) FILTER (lang = 'en') / count(*) * 100, 2) AS pct
    FROM documents GROUP BY source""")
def pct_round(spark, sf):
    docs = io.load_table(spark, sf, "documents")
    return docs.groupBy("source").agg(
        profile.pct_round(F.count_if(F.col("lang") == "en"), F.count("*")).alias("pct"))


@query("label_range", with_views(
    """SELECT min(label) AS min_label, max(label) AS max_label,
      string_agg(DISTINCT CAST(label AS VARCHAR), ',' ORDER BY CAST(label AS VARCHAR)) AS labels FROM labelled""",
    "labelled"))
def label_range(spark, sf):
    row = profile.label_range(tables.labelled(spark, sf))
    return row.withColumn("labels", F.array_join("labels", ","))


FOLD_COUNTS = ", ".join(f"count(*) FILTER (label = {v}) AS label_{v}" for v in L.LABELS)


def _folds(spark, sf):
    return folds.stratified_kfold(tables.labelled(spark, sf))


@query("fold_distribution", with_views(
    f"SELECT fold, {FOLD_COUNTS}, count(*) AS n FROM folds GROUP BY fold", "folds"))
def fold_distribution(spark, sf):
    return profile.fold_distribution(_folds(spark, sf), L.LABELS)


@query("fold_spread", with_views(
    " UNION ALL ".join(
        f"SELECT {v} AS label, round(stddev_samp(label_{v}), 6) AS std, stddev_samp(label_{v}) > 5 AS uneven FROM d"
        for v in L.LABELS), "folds", d=f"SELECT fold, {FOLD_COUNTS} FROM folds GROUP BY fold"))
def fold_spread(spark, sf):
    counts = profile.fold_distribution(_folds(spark, sf), L.LABELS)
    return profile.fold_spread(counts, L.LABELS).withColumn("std", F.round("std", 6))


@query("topk_venues", with_views(
    """SELECT venue, count(*) AS n FROM paper_texts WHERE venue IS NOT NULL GROUP BY venue
      ORDER BY n DESC, venue LIMIT 20""", "paper_texts"))
def topk_venues(spark, sf):
    return profile.top_values(tables.paper_texts(spark, sf), "venue", 20)


@query("head", "SELECT o_orderkey AS id, o_orderpriority AS title FROM orders ORDER BY o_orderkey LIMIT 50")
def head(spark, sf):
    rows = io.load_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"))
    return rows.orderBy("id").limit(50)


@query("sort_index", with_views(
    "SELECT venue, count(*) AS n FROM papers_meta GROUP BY venue ORDER BY venue", "papers_meta"))
def sort_index(spark, sf):
    return tables.papers_meta(spark, sf).groupBy("venue").agg(F.count("*").alias("n")).orderBy("venue")


@query("corpus_size", with_views(
    f"SELECT count(*) AS n_rows, {len(COLUMNS)} AS n_columns, '{', '.join(COLUMNS)}' AS columns FROM papers",
    "papers"))
def corpus_size(spark, sf):
    return profile.corpus_size(tables.papers(spark, sf).select(*COLUMNS))
