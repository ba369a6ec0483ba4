"""SQL text for the equivalents: views over the supplied tables and scalar fragments."""

from __future__ import annotations

from ..functions.core import WHITESPACE
from ..functions.stopwords import english_stop_words

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def trim(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {trim(x)} = '')"


def clean_text(x: str) -> str:
    no_url = rf"regexp_replace(lower(coalesce({x}, '')), 'http[^\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g')"
    kept = rf"regexp_replace({no_url}, '[^a-z0-9\s\-:&/]', ' ', 'g')"
    return rf"trim(regexp_replace({kept}, '\s+', ' ', 'g'))"


def clean_author(x: str) -> str:
    collapsed = f"regexp_replace({trim(x)}, '{WS}+', ' ', 'g')"
    return rf"trim(regexp_replace({collapsed}, '[^\p{{L}}\p{{N}}_ ]', '', 'g'))"


def author_list(x: str) -> str:
    cleaned = f"list_transform(string_split(coalesce({x}, ''), ','), lambda a: {clean_author('a')})"
    return f"array_to_string(list_filter({cleaned}, lambda a: a <> ''), ', ')"


def names(x: str) -> str:
    trimmed = f"list_transform(string_split(coalesce({x}, ''), ','), lambda a: {trim('a')})"
    return f"list_filter({trimmed}, lambda a: a <> '')"


def last_names(x: str) -> str:
    tokens = f"regexp_split_to_array(a, '{WS}+')"
    return f"array_to_string(list_transform({names(f'lower({x})')}, lambda a: {tokens}[-1]), ' ')"


def year_int(x: str) -> str:
    return f"coalesce(CAST(trunc(try_cast({x} AS DOUBLE)) AS BIGINT), 0)"


def doi(x: str) -> str:
    out = trim(f"coalesce({x}, '')")
    for prefix in ("https://doi.org/", "http://doi.org/", "DOI:", "doi:"):
        out = f"replace({out}, '{prefix}', '')"
    return trim(out)


def tokens(x: str) -> str:
    return rf"regexp_extract_all(lower(coalesce({x}, '')), '[\p{{L}}\p{{N}}_]{{2,}}')"


def stop_list() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words()) + "]"


def content_tokens(x: str) -> str:
    return f"list_filter({tokens(x)}, lambda t: NOT list_contains({stop_list()}, t))"


def bigrams(t: str) -> str:
    return f"list_transform(range(1, len({t})), lambda i: {t}[i] || ' ' || {t}[i + 1])"


PREDICTION_SHIFT = (
    "CASE WHEN floor(o_totalprice)::BIGINT % 10 < 6 THEN 0 "
    "WHEN floor(o_totalprice)::BIGINT % 10 < 8 THEN 1 "
    "WHEN floor(o_totalprice)::BIGINT % 10 = 8 THEN -1 ELSE 2 END"
)

# name -> (needed views, text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "authors_by_order": ((), """
        SELECT l_orderkey AS id, string_agg(s_name, ', ' ORDER BY s_suppkey) AS authors
        FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l
        JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey"""),
    "paper_texts": ((), """
        SELECT doc_id AS id, split_part(text, '.', 1) AS title,
          CASE WHEN source IN ('src3', 'src7') THEN NULL WHEN source = 'src5' THEN '  ' || chr(9)
            ELSE text END AS abstract,
          CASE WHEN source <> 'src11' THEN source END AS venue,
          CASE source WHEN 'src13' THEN 'n/a' WHEN 'src17' THEN '2015.7' WHEN 'src19' THEN NULL
            ELSE CAST(1990 + n_chars % 36 AS VARCHAR) END AS year,
          CASE source WHEN 'src2' THEN 'DOI:10.5555/' || doc_id
            WHEN 'src4' THEN '  http://doi.org/10.5555/' || doc_id || ' '
            WHEN 'src6' THEN '' WHEN 'src8' THEN NULL
            ELSE 'https://doi.org/10.5555/' || doc_id END AS doi,
          CAST(least(5, 1 + n_chars // 800) AS INTEGER) AS label
        FROM documents"""),
    "papers": (("paper_texts", "authors_by_order"), """
        SELECT p.*, CASE WHEN venue IN ('src9', 'src10') THEN NULL WHEN venue = 'src12' THEN ' '
          ELSE a.authors END AS authors
        FROM paper_texts p LEFT JOIN authors_by_order a USING (id)"""),
    "papers_meta": ((), """
        SELECT o_orderkey AS id, c_mktsegment AS venue, CAST(year(o_orderdate) AS INTEGER) AS year,
          CAST(o_orderpriority[1] AS INTEGER) AS label
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""),
    "papers_meta_authors": (("papers_meta", "authors_by_order"), """
        SELECT p.*, a.authors FROM papers_meta p LEFT JOIN authors_by_order a USING (id)"""),
    "labelled": ((), """
        SELECT o_orderkey AS id, CAST(o_orderpriority[1] AS INTEGER) AS label FROM orders"""),
    "predictions": ((), f"""
        SELECT o_orderkey AS id, CAST(o_orderpriority[1] AS INTEGER) AS label,
          CAST(greatest(1, least(5, CAST(o_orderpriority[1] AS INTEGER) + {PREDICTION_SHIFT}))
            AS INTEGER) AS prediction,
          CAST(o_orderpriority[1] AS INTEGER)
            + (floor(o_totalprice)::BIGINT % 301 - 150) / 100.0::DOUBLE AS score
        FROM orders"""),
    "vectors": ((), """
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS embedding,
          CAST(least(5, 1 + label // 2) AS INTEGER) AS label FROM embeddings"""),
    "crawl": (("authors_by_order",), """
        SELECT d.doc_id AS id, '10.5555/' || d.doc_id AS doi,
          CASE WHEN quality = 1 THEN text END AS abstract, a.authors AS crawled_authors, source
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id
        LEFT JOIN authors_by_order a ON a.id = d.doc_id"""),
    "seed": (("authors_by_order",), """
        SELECT doc_id AS id, text, CAST(source[4:] AS INTEGER) AS nr, coalesce(authors, '') AS authors
        FROM documents d LEFT JOIN authors_by_order a ON a.id = d.doc_id"""),
    # What the parsers have to find in the landed answers, read from the same fields.
    "answers": (("seed",), rf"""
        SELECT id, 'semantic_scholar' AS source, 1 AS priority, '10.1000/' || id AS found_doi,
          CASE WHEN nr IN (5, 6, 7, 8, 9) THEN '' ELSE {trim('text')} END AS abstract,
          CASE WHEN nr IN (10, 11) THEN '' ELSE authors END AS authors,
          nr NOT IN (0, 1, 2, 3, 4) AS by_doi, nr NOT IN (14, 1, 12) AS by_title,
          2 AS title_priority, nr FROM seed
        UNION ALL
        SELECT id, 'crossref', 2, '10.2000/' || id,
          CASE WHEN nr IN (5, 6) THEN '' ELSE {trim('text')} END,
          CASE WHEN nr = 7 THEN '' ELSE replace(authors, '#', ' ') END,
          nr NOT IN (0, 1, 2), nr NOT IN (15, 2), 3, nr FROM seed
        UNION ALL
        SELECT id, 'openalex', 3, 'https://doi.org/10.3000/' || id,
          CASE WHEN nr = 8 THEN '' ELSE regexp_replace(trim(text, E' \n'), '[ \n]+', ' ', 'g') END,
          authors, nr NOT IN (0, 1), nr NOT IN (12, 0, 13), 1, nr FROM seed
        UNION ALL
        SELECT id, 'doi_page', 4, '', CASE WHEN nr = 4 THEN '' ELSE
            {trim("replace(replace(replace(replace(text, '&lt;', '<'), '&gt;', '>'), '&#39;', chr(39)), '&amp;', '&')")} END,
          '', nr <> 0, false, NULL, nr FROM seed"""),
    "lookups": (("paper_texts",), f"""
        SELECT id, {doi('doi')} AS doi FROM paper_texts WHERE {doi('doi')} <> ''"""),
    "best": (("answers", "lookups"), f"""
        SELECT a.id, l.doi, abstract, authors AS crawled_authors, source
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
            CASE WHEN length({trim('abstract')}) > 30 AND authors <> '' THEN 0 ELSE 1 END, priority) AS r
          FROM answers WHERE by_doi) a JOIN lookups l ON a.id = l.id WHERE r = 1"""),
    "title_best": (("answers", "paper_texts"), f"""
        SELECT a.id, {doi("CASE WHEN found_doi <> '' THEN found_doi ELSE p.doi END")} AS doi,
          a.abstract, authors AS crawled_authors
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY title_priority) AS r
          FROM answers WHERE by_title AND abstract <> '') a
        JOIN paper_texts p ON a.id = p.id WHERE r = 1 AND p.title <> ''"""),
    "folds": (("labelled",), """
        SELECT id, label, CAST((row_number() OVER (PARTITION BY label
          ORDER BY md5(CAST(id AS VARCHAR)), id) - 1) % 5 AS INTEGER) AS fold FROM labelled"""),
    "vector_split": (("vectors",), """
        SELECT id, label, embedding, CASE WHEN row_number() OVER (PARTITION BY label
            ORDER BY md5(CAST(id AS VARCHAR)), id) - 1
          < round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split
        FROM vectors"""),
    "replies": ((), r"""
        SELECT o_orderkey AS id, o_orderpriority AS title, CAST(o_orderpriority[1] AS INTEGER) AS Label,
          floor(o_totalprice)::BIGINT % 10 = 9 AS broken,
          CAST(o_orderpriority[1] AS INTEGER) + CASE WHEN floor(o_totalprice)::BIGINT % 10 < 6 THEN 0
            WHEN floor(o_totalprice)::BIGINT % 10 < 8 THEN 1 ELSE 5 END AS said
        FROM orders"""),
    "parsed_replies": (("replies",), """
        SELECT id, title, Label, CASE WHEN NOT broken THEN CAST(least(5, said) AS INTEGER) END AS llm_score,
          CASE WHEN broken THEN 'invalid JSON' ELSE title END AS llm_reason FROM replies"""),
}


def with_views(body: str, *views: str, **extra: str) -> str:
    """``body`` behind the views it needs; ``extra`` are further named queries, in order."""
    done: list[str] = []

    def need(name: str) -> None:
        if name in done:
            return
        for dep in VIEWS[name][0]:
            need(dep)
        done.append(name)

    for v in views:
        need(v)
    parts = [f"{v} AS ({VIEWS[v][1]})" for v in done]
    parts += [f"{k} AS ({v})" for k, v in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
