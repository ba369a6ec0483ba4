"""Landed API responses and landing pages to crawl fields.

Each parser takes the payload column and returns a struct ``(doi, abstract, authors)`` with
blanks for what is missing. ``PARSERS`` maps a source to its parser and its priority, so a new
source is one more entry.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .core import bind, col, safe_text, trim_ws
from .records import format_authors

S2_ITEM = (
    "struct<abstract:string,authors:array<struct<name:string>>,externalIds:struct<DOI:string>>"
)
CROSSREF_ITEM = (
    "struct<abstract:string,author:array<struct<given:string,family:string>>,DOI:string>"
)
OPENALEX_ITEM = (
    "struct<abstract_inverted_index:map<string,array<int>>,"
    "authorships:array<struct<author:struct<display_name:string>>>,doi:string>"
)

# The meta names read from a landing page, first one with content wins.
META_NAMES = ("citation_abstract", "description", "dc.description")


def _record(doi: Column, abstract: Column, authors: Column) -> Column:
    return F.struct(
        safe_text(doi).alias("doi"),
        trim_ws(safe_text(abstract)).alias("abstract"),
        safe_text(authors).alias("authors"),
    )


def _join_names(names: Column) -> Column:
    trimmed = F.transform(names, lambda n: trim_ws(safe_text(n)))
    return format_authors(F.filter(trimmed, lambda n: n != ""))


def _read_json(payload: Column | str, schema: str, body: Callable[[Column], Column]) -> Column:
    """``body`` of the parsed document; null when the payload is null or no valid JSON."""
    doc = F.from_json(
        col(payload), schema[:-1] + ",_bad:string>", {"columnNameOfCorruptRecord": "_bad"}
    )
    return bind(doc, lambda d: F.when(d.isNotNull() & d["_bad"].isNull(), body(d)))


def inverted_index_text(index: Column) -> Column:
    """Words in position order; of two words at one position the later entry counts.

    Position and entry number are packed into one long, so the sort compares plain numbers.
    """
    words = F.map_keys(index)
    none = F.array().cast("array<int>")
    packed = F.flatten(
        F.transform(
            F.map_values(index),
            lambda positions, nr: F.transform(
                F.coalesce(positions, none), lambda p: F.shiftleft(p.cast("long"), 32) + nr
            ),
        )
    )

    def last_per_position(s: Column) -> Column:
        return F.filter(
            s,
            lambda x, i: F.coalesce(
                F.shiftright(F.get(s, i + 1), 32) != F.shiftright(x, 32), F.lit(True)
            ),
        )

    def spell(keys: Column) -> Column:
        kept = bind(F.sort_array(packed), last_per_position)
        entry = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        return F.array_join(F.transform(kept, lambda x: F.get(keys, entry(x))), " ")

    return bind(words, spell)


def semantic_scholar_item(item: Column) -> Column:
    names = F.transform(item["authors"], lambda a: a["name"])
    return _record(item["externalIds"]["DOI"], item["abstract"], _join_names(names))


def crossref_item(item: Column) -> Column:
    names = F.transform(
        item["author"],
        lambda a: F.concat(safe_text(a["given"]), F.lit(" "), safe_text(a["family"])),
    )
    abstract = F.regexp_replace(safe_text(item["abstract"]), "</?(jats:)?p>", "")
    return _record(item["DOI"], abstract, _join_names(names))


def openalex_item(item: Column) -> Column:
    names = F.transform(item["authorships"], lambda a: a["author"]["display_name"])
    abstract = inverted_index_text(item["abstract_inverted_index"])
    return _record(item["doi"], abstract, _join_names(names))


def parse_semantic_scholar(payload: Column | str) -> Column:
    return _read_json(payload, S2_ITEM, semantic_scholar_item)


def parse_crossref(payload: Column | str) -> Column:
    schema = f"struct<message:{CROSSREF_ITEM}>"
    return _read_json(payload, schema, lambda d: crossref_item(d["message"]))


def parse_openalex(payload: Column | str) -> Column:
    return _read_json(payload, OPENALEX_ITEM, openalex_item)


def _first_hit(payload: Column | str, schema: str, hits: Callable[[Column], Column],
               item: Callable[[Column], Column]) -> Column:
    def first(doc: Column) -> Column:
        hit = F.get(hits(doc), F.lit(0))
        return F.when(hit.isNotNull(), item(hit))

    return _read_json(payload, schema, first)


def search_openalex(payload: Column | str) -> Column:
    schema = f"struct<results:array<{OPENALEX_ITEM}>>"
    return _first_hit(payload, schema, lambda d: d["results"], openalex_item)


def search_semantic_scholar(payload: Column | str) -> Column:
    schema = f"struct<data:array<{S2_ITEM}>>"
    return _first_hit(payload, schema, lambda d: d["data"], semantic_scholar_item)


def search_crossref(payload: Column | str) -> Column:
    schema = f"struct<message:struct<items:array<{CROSSREF_ITEM}>>>"
    return _first_hit(payload, schema, lambda d: d["message"]["items"], crossref_item)


# --- landing pages ------------------------------------------------------------------------

META_TAG = (
    r"""(?i)<meta(?:\s+[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?)*\s*/?>"""
)


def _attribute(tag: Column, name: str) -> Column:
    """Value of one attribute of a tag, quotes optional; null when the tag lacks it."""
    found = F.regexp_extract(
        tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1
    )
    return F.when(found != "", F.regexp_replace(found, r"""^["']|["']$""", ""))


def _unescape(x: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def meta_abstract(html: Column | str) -> Column:
    """Content of the first meta tag of each name, in name order; blank when none has any."""

    def pick(tags: Column) -> Column:
        def content(name: str) -> Column:
            named = F.filter(tags, lambda t: _attribute(t, "name") == name)
            value = _attribute(F.get(named, F.lit(0)), "content")
            return F.when(value != "", trim_ws(_unescape(value)))

        return F.coalesce(*[content(n) for n in META_NAMES], F.lit(""))

    return bind(F.regexp_extract_all(safe_text(html), F.lit(META_TAG), F.lit(0)), pick)


def parse_html_meta(html: Column | str) -> Column:
    return _record(F.lit(""), meta_abstract(html), F.lit(""))


@dataclass(frozen=True)
class Source:
    parse: Callable[[Column | str], Column]
    priority: int


# Lookup by identifier, in the order the sources are asked.
DOI_SOURCES = {
    "semantic_scholar": Source(parse_semantic_scholar, 1),
    "crossref": Source(parse_crossref, 2),
    "openalex": Source(parse_openalex, 3),
    "doi_page": Source(parse_html_meta, 4),
}

# Lookup by title.
TITLE_SOURCES = {
    "openalex": Source(search_openalex, 1),
    "semantic_scholar": Source(search_semantic_scholar, 2),
    "crossref": Source(search_crossref, 3),
}
