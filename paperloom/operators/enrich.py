"""From landed responses to one crawl record per paper."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.core import safe_text
from ..functions.payloads import DOI_SOURCES, TITLE_SOURCES, Source
from ..functions.records import build_result, is_complete_result, is_valid_result, normalize_doi


def usable_responses(responses: DataFrame) -> DataFrame:
    """Successful answers only."""
    return responses.where(F.col("status") == 200)


def lookups(papers: DataFrame) -> DataFrame:
    """Papers that can be looked up by identifier."""
    return papers.withColumn("doi", normalize_doi("doi")).where(F.col("doi") != "")


def _by_source(responses: DataFrame, sources: Mapping[str, Source]) -> DataFrame:
    """Parse each answer with the parser of its source; unreadable answers are dropped."""
    ok = usable_responses(responses)

    def pick(attribute) -> Column:
        names = list(sources)
        expr = F.when(F.col("source") == names[0], attribute(names[0]))
        return reduce(lambda e, s: e.when(F.col("source") == s, attribute(s)), names[1:], expr)

    # ``inline`` parses each payload once and drops the unreadable ones.
    record = pick(lambda s: sources[s].parse("payload"))
    return ok.select(
        "id",
        "source",
        pick(lambda s: F.lit(sources[s].priority)).alias("priority"),
        F.inline(F.array_compact(F.array(record))),
    ).withColumnRenamed("doi", "found_doi")


def parse_source(responses: DataFrame, papers: DataFrame, source: str) -> DataFrame:
    """Crawl records of one source, for papers with an identifier."""
    one = responses.where(F.col("source") == source)
    found = _by_source(one, {source: DOI_SOURCES[source]})
    return found.join(lookups(papers).select("id", "doi"), "id").select(
        *build_result("id", "doi", "abstract", "authors")
    )


def search_hits(responses: DataFrame, sources: Mapping[str, Source] = TITLE_SOURCES) -> DataFrame:
    """The first hit of every title search that found one."""
    return _by_source(responses, sources)


def _last_keys() -> list[Column]:
    """An order among answers of equal rank that does not depend on the order of the rows."""
    return [-F.length(safe_text("abstract")), F.xxhash64("abstract", "authors", "found_doi"),
            F.col("abstract"), F.col("authors"), F.col("found_doi")]


def priority_fallback(responses: DataFrame, papers: DataFrame) -> DataFrame:
    """Per paper the first complete record in source order, else the first record at all.

    ``min_by`` keeps one candidate per paper and map task, so only winners are shuffled. Of several
    answers of one source the one with the longest abstract wins, then the least hash and text.
    """
    candidates = _by_source(responses, DOI_SOURCES)
    rank = F.struct(~is_complete_result("abstract", "authors"), F.col("priority"), *_last_keys())
    best = candidates.groupBy("id").agg(
        F.min_by(F.struct("abstract", "authors", "source"), rank).alias("b")
    )
    return best.join(lookups(papers).select("id", "doi"), "id").select(
        *build_result("id", "doi", "b.abstract", "b.authors"), F.col("b.source").alias("source")
    )


def title_search_fallback(responses: DataFrame, papers: DataFrame) -> DataFrame:
    """Per paper the first title hit with an abstract; its identifier if it has one."""
    hits = search_hits(responses).where(F.col("abstract") != "")
    best = hits.groupBy("id").agg(
        F.min_by(F.struct("found_doi", "abstract", "authors"), F.struct("priority", *_last_keys())).alias("b")
    )
    titled = papers.where(safe_text("title") != "").select("id", "doi")
    own = F.when(F.col("b.found_doi") != "", F.col("b.found_doi")).otherwise(F.col("doi"))
    return best.join(titled, "id").select(*build_result("id", own, "b.abstract", "b.authors"))


def batch_enrich(papers: DataFrame, results: DataFrame) -> DataFrame:
    """One row per paper; nulls where nothing was found."""
    return papers.select("id").join(results, "id", "left")


def title_recovery(best: DataFrame, title_results: DataFrame) -> DataFrame:
    """Fill what the lookup by identifier left open from the title search.

    An incomplete record takes the missing fields of the title hit; a paper without any
    record takes the title hit when its abstract is long enough.
    """
    title = title_results.select(
        F.col("id"),
        F.col("doi").alias("t_doi"),
        F.col("abstract").alias("t_abstract"),
        F.col("crawled_authors").alias("t_authors"),
    )
    both = best.withColumn("_own", F.lit(True)).join(title, "id", "full")
    has_own = F.col("_own").isNotNull()
    open_ = has_own & ~is_complete_result("abstract", "crawled_authors")

    def filled(own: str, other: str) -> Column:
        missing = safe_text(own) == ""
        return F.when(~has_own | (open_ & missing), safe_text(other)).otherwise(F.col(own))

    kept = both.where(has_own | is_valid_result("t_abstract"))
    return kept.select(
        "id",
        F.when(has_own, F.col("doi")).otherwise(F.col("t_doi")).alias("doi"),
        filled("abstract", "t_abstract").alias("abstract"),
        filled("crawled_authors", "t_authors").alias("crawled_authors"),
        F.coalesce(F.col("source"), F.lit("title_search")).alias("source"),
    )


def crawl_records(doi_responses: DataFrame, title_responses: DataFrame, papers: DataFrame) -> DataFrame:
    """The whole fallback chain: identifier lookups, then title recovery."""
    best = priority_fallback(doi_responses, papers)
    return title_recovery(best, title_search_fallback(title_responses, papers))
