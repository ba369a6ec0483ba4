"""Identifiers, years and the standard crawl record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .core import col, safe_text, trim_ws

# Prefixes removed from identifiers, in this order.
DOI_PREFIXES = ("https://doi.org/", "http://doi.org/", "DOI:", "doi:")

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def normalize_doi(doi: Column | str) -> Column:
    out = trim_ws(safe_text(doi))
    for prefix in DOI_PREFIXES:
        out = F.replace(out, F.lit(prefix), F.lit(""))
    return trim_ws(out)


def format_authors(names: Column | str) -> Column:
    """Array of names to one trimmed, comma-separated string."""
    kept = F.filter(col(names), lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(F.array_join(F.transform(kept, trim_ws), ", "), F.lit(""))


def build_result(paper_id, doi, abstract, authors) -> list[Column]:
    """The columns of a crawl record, with blanks for what is missing."""
    return [
        col(paper_id).alias("id"),
        normalize_doi(doi).alias("doi"),
        safe_text(abstract).alias("abstract"),
        safe_text(authors).alias("crawled_authors"),
    ]


def year_int(year: Column | str) -> Column:
    """Any number within 64 bits, cut to an integer; 0 for everything else."""
    text = col(year).cast("string")
    number = F.when(text.rlike(NUMBER), text).try_cast("double")
    return F.coalesce(number.try_cast("long"), F.lit(0).cast("long"))


def year_norm(year: Column | str) -> Column:
    """Distance from 2000 in units of 30 years. A number is cut to an integer; a text that is no
    integer counts as 2000."""
    text = col(year).cast("string")
    fraction = F.typeof(col(year)).rlike("^(double|float|decimal)")
    cut = F.when(fraction, text).try_cast("double").try_cast("long")
    whole = F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text).try_cast("long")
    return (F.coalesce(cut, whole, F.lit(2000)) - 2000) / F.lit(30.0)


def is_valid_result(abstract: Column | str) -> Column:
    return F.length(trim_ws(safe_text(abstract))) > 30


def is_complete_result(abstract: Column | str, authors: Column | str) -> Column:
    return is_valid_result(abstract) & (safe_text(authors) != "")
