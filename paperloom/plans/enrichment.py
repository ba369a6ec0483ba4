"""Landed responses, fallback order and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.payloads import meta_abstract
from ..functions.records import normalize_doi
from ..operators import cleaning, enrich
from ..sources import tables
from . import sql as Q
from .registry import query
from .sql import with_views


def _parsed_sql(source: str) -> str:
    return with_views(
        f"""SELECT a.id, l.doi, abstract, authors AS crawled_authors
          FROM answers a JOIN lookups l ON a.id = l.id WHERE source = '{source}' AND by_doi""",
        "answers", "lookups")


def _parse(spark, sf, source):
    return enrich.parse_source(
        tables.responses(spark, sf, "doi", source), tables.paper_texts(spark, sf), source)


@query("parse_semantic_scholar", _parsed_sql("semantic_scholar"))
def parse_semantic_scholar(spark, sf):
    return _parse(spark, sf, "semantic_scholar")


@query("parse_crossref", _parsed_sql("crossref"))
def parse_crossref(spark, sf):
    return _parse(spark, sf, "crossref")


@query("parse_openalex", _parsed_sql("openalex"))
def parse_openalex(spark, sf):
    return _parse(spark, sf, "openalex")


@query("parse_doi_page", _parsed_sql("doi_page"))
def parse_doi_page(spark, sf):
    return _parse(spark, sf, "doi_page")


@query("parse_html_meta", """
    SELECT page_id AS id, CASE WHEN contains(url, '/fr/') OR contains(url, '/de/') THEN 'Page <b> at ' || url
      WHEN contains(url, '/es/') THEN '' ELSE 'Page <b> at ' || url END AS abstract FROM pages""")
def parse_html_meta(spark, sf):
    return tables.pages_meta(spark, sf).select("id", meta_abstract("html").alias("abstract"))


@query("parse_search_hit", with_views(
    """SELECT id, source, title_priority AS priority, found_doi, abstract, authors FROM answers
      WHERE by_title""", "answers"))
def parse_search_hit(spark, sf):
    return enrich.search_hits(tables.responses(spark, sf, "title"))


@query("response_filter", with_views(
    """SELECT a.id, a.source, l.doi FROM answers a JOIN lookups l ON a.id = l.id WHERE by_doi""",
    "answers", "lookups"))
def response_filter(spark, sf):
    ok = enrich.usable_responses(tables.responses(spark, sf, "doi"))
    wanted = enrich.lookups(tables.paper_texts(spark, sf)).select("id", "doi")
    return ok.join(wanted, "id").select("id", "source", "doi")


@query("enrich_left_join", with_views(
    """SELECT p.id, p.title, p.abstract, p.authors, c.abstract AS abstract_crawl, c.crawled_authors, c.source,
      c.doi AS doi_crawl FROM papers p LEFT JOIN crawl c ON p.id = c.id""", "papers", "crawl"))
def enrich_left_join(spark, sf):
    base = tables.papers(spark, sf).select("id", "title", "abstract", "authors", "doi")
    return cleaning.enrich_left_join(base, tables.crawl(spark, sf)).drop("doi")


@query("enrich_coalesce", with_views(
    f"""SELECT p.id, p.venue, CASE WHEN {Q.blank('p.abstract')} THEN c.abstract ELSE p.abstract END AS abstract,
      CASE WHEN {Q.blank('p.authors')} THEN c.crawled_authors ELSE p.authors END AS authors
      FROM papers p LEFT JOIN crawl c ON p.id = c.id""", "papers", "crawl"))
def enrich_coalesce(spark, sf):
    base = tables.papers(spark, sf).select("id", "venue", "abstract", "authors")
    return cleaning.merge_records(base, tables.crawl(spark, sf).drop("doi"))


@query("priority_fallback", with_views("SELECT * FROM best", "best"))
def priority_fallback(spark, sf):
    return enrich.priority_fallback(tables.responses(spark, sf, "doi"), tables.paper_texts(spark, sf))


@query("title_search_fallback", with_views("SELECT * FROM title_best", "title_best"))
def title_search_fallback(spark, sf):
    return enrich.title_search_fallback(tables.responses(spark, sf, "title"), tables.paper_texts(spark, sf))


@query("batch_enrich", with_views(
    """SELECT p.id, t.doi, t.abstract, t.crawled_authors FROM paper_texts p LEFT JOIN title_best t ON p.id = t.id""",
    "paper_texts", "title_best"))
def batch_enrich(spark, sf):
    papers = tables.paper_texts(spark, sf)
    found = enrich.title_search_fallback(tables.responses(spark, sf, "title"), papers)
    return enrich.batch_enrich(papers, found)


INCOMPLETE = f"NOT (length({Q.trim('b.abstract')}) > 30 AND b.crawled_authors <> '')"


@query("title_recovery", with_views(
    f"""SELECT coalesce(b.id, t.id) AS id, CASE WHEN b.id IS NOT NULL THEN b.doi ELSE t.doi END AS doi,
      CASE WHEN b.id IS NULL OR ({INCOMPLETE} AND b.abstract = '') THEN coalesce(t.abstract, '')
        ELSE b.abstract END AS abstract,
      CASE WHEN b.id IS NULL OR ({INCOMPLETE} AND b.crawled_authors = '') THEN coalesce(t.crawled_authors, '')
        ELSE b.crawled_authors END AS crawled_authors,
      coalesce(b.source, 'title_search') AS source
      FROM best b FULL JOIN title_best t ON b.id = t.id
      WHERE b.id IS NOT NULL OR length({Q.trim('t.abstract')}) > 30""", "best", "title_best"))
def title_recovery(spark, sf):
    return enrich.crawl_records(
        tables.responses(spark, sf, "doi"), tables.responses(spark, sf, "title"), tables.paper_texts(spark, sf))


MERGED = f"""
    SELECT p.id, {Q.clean_text('p.title')} AS title, coalesce(p.venue, 'unknown') AS venue,
      {Q.year_int('p.year')} AS year,
      {Q.clean_text(f"CASE WHEN {Q.blank('p.abstract')} THEN c.abstract ELSE p.abstract END")} AS abstract,
      {Q.author_list(f"CASE WHEN {Q.blank('p.authors')} THEN c.crawled_authors ELSE p.authors END")} AS authors
    FROM papers p LEFT JOIN crawl c ON p.id = c.id"""


@query("clean_records", with_views(MERGED, "papers", "crawl"))
def clean_records(spark, sf):
    """Merge, fill, normalise and clean in one plan: one join, everything else narrow."""
    base = tables.papers(spark, sf).drop("label", "doi")
    return cleaning.clean_records(cleaning.merge_records(base, tables.crawl(spark, sf).drop("doi")))


@query("doi_lookups", with_views("SELECT id, doi FROM lookups", "lookups"))
def doi_lookups(spark, sf):
    rows = tables.paper_texts(spark, sf).select("id", normalize_doi("doi").alias("doi"))
    return rows.where(F.col("doi") != "")
