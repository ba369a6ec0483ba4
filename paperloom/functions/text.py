"""Cleaning, tokenising and prompt-building on text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .core import WORD, WS, bind, col, is_blank, safe_text, trim_ws


def clean_text(x: Column | str) -> Column:
    """Lower-case, drop URLs, keep ``a-z 0-9 - : & /``, collapse everything else to one space.

    Collecting the runs of kept characters is several times faster than replacing the others.
    """
    no_urls = F.regexp_replace(F.lower(safe_text(x)), f"http[^{WS}]+", " ")
    return F.array_join(F.regexp_extract_all(no_urls, F.lit(r"[a-z0-9\-:&/]+"), F.lit(0)), " ")


def clean_author(x: Column | str) -> Column:
    """Collapse white space, then delete punctuation; letters of any script stay."""
    collapsed = F.regexp_replace(trim_ws(x), f"[{WS}]+", " ")
    return F.trim(F.regexp_replace(collapsed, f"[^{WORD} ]", ""))


def split_authors(authors: Column | str) -> Column:
    """Trimmed non-empty names of a comma-separated list; an empty array for null."""
    names = F.transform(F.split(safe_text(authors), ","), trim_ws)
    return F.filter(names, lambda n: n != "")


def normalize_author_list(authors: Column | str) -> Column:
    cleaned = F.transform(F.split(safe_text(authors), ","), clean_author)
    return F.array_join(F.filter(cleaned, lambda n: n != ""), ", ")


def author_last_names(authors: Column | str) -> Column:
    """``J. Smith, A. van Dyk`` becomes ``smith dyk``."""
    last = F.transform(
        split_authors(F.lower(safe_text(authors))),
        lambda n: F.element_at(F.split(n, f"[{WS}]+"), -1),
    )
    return F.array_join(last, " ")


def author_count_raw(authors: Column | str) -> Column:
    """Comma-separated parts, blanks included; null counts as one."""
    return F.size(F.split(F.coalesce(col(authors), F.lit("nan")), ","))


# --- tokens and n-grams -------------------------------------------------------------------


def tokenize_words(x: Column | str) -> Column:
    """Lower-case runs of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(safe_text(x)), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def remove_stop_words(tokens: Column | str, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return col(tokens)
    words = list(stop_words)
    return F.filter(col(tokens), lambda t: ~t.isin(words))


def ngrams_1_2(tokens: Column | str) -> Column:
    """Unigrams followed by bigrams."""

    def build(t: Column) -> Column:
        pairs = F.greatest(F.size(t) - 1, F.lit(0))
        bigrams = F.zip_with(
            F.slice(t, 1, pairs), F.slice(t, 2, pairs), lambda a, b: F.concat_ws(" ", a, b)
        )
        return F.concat(t, bigrams)

    return bind(col(tokens), build)


def term_counts(terms: Column | str) -> Column:
    """Array of ``(term, tf)`` per row: sort, then measure the runs. No shuffle is needed."""

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return bind(
            starts,
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(st, j + 1), n) - p).alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return bind(
        F.sort_array(col(terms)), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty)
    )


def analyze(x: Column | str, stop_words: Sequence[str] = (), bigrams: bool = True) -> Column:
    """Text to terms: words, minus stop words, plus bigrams of what is left."""
    tokens = remove_stop_words(tokenize_words(x), stop_words)
    return ngrams_1_2(tokens) if bigrams else tokens


# --- prompts ------------------------------------------------------------------------------


def prompt_sbert(title, abstract, authors, venue, year) -> Column:
    parts = zip(
        ("Title: ", " [SEP] Abstract: ", " Authors: ", " Venue: ", " Year: "),
        (title, abstract, authors, venue, year),
    )
    return F.concat(*[piece for lead, x in parts for piece in (F.lit(lead), safe_text(x))])


def authors_short(authors: Column | str, keep: int = 3) -> Column:
    """The first names of the list, with ``et al.`` when there are more."""
    return bind(
        split_authors(authors),
        lambda a: F.concat(
            F.array_join(F.slice(a, 1, keep), ", "),
            F.when(F.size(a) > keep, " et al.").otherwise(""),
        ),
    )


def prompt_scibert(title, abstract, year, authors) -> Column:
    return F.concat(
        trim_ws(safe_text(title)),
        F.lit(" [SEP] "),
        trim_ws(safe_text(abstract)),
        F.lit(" [SEP] year: "),
        trim_ws(safe_text(year)),
        F.lit(", authors: "),
        authors_short(authors),
    )


def prompt_venue(venue, year, authors, title, abstract) -> Column:
    return F.format_string(
        "venue: %s year: %s authors: %s %s ( %s ) [SEP] %s",
        *[safe_text(x) for x in (venue, year, authors, title, venue, abstract)],
    )


def prompt_keyword(title, abstract) -> Column:
    t = safe_text(title)
    has_abstract = safe_text(abstract) != ""
    return F.when(has_abstract, F.concat(t, F.lit(". "), safe_text(abstract))).otherwise(t)


def presence_flag(x: Column | str) -> Column:
    return (~is_blank(x)).cast("int")


def authors_flag(authors: Column | str) -> Column:
    """1 if the list has a name; separators and white space alone are none."""
    return (F.size(split_authors(authors)) > 0).cast("int")
