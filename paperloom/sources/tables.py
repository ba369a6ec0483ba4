"""Record views over the supplied tables.

No table of papers is supplied, so the views below give the supplied rows the shape the
operators work on. Gaps (missing abstracts, odd years, failed lookups) follow from attribute
values of the row, and every row of the underlying table is in the view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .io import load_table


def _source_nr() -> Column:
    return F.substring("source", 4, 10).cast("int")


def authors_by_order(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """``id, authors``: the distinct suppliers of an order as a comma-separated name list.

    With ``wanted``, a table of ids, only for its orders: the others leave before they are grouped.
    """
    link = load_table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    if wanted is not None:
        link = link.join(wanted.select(F.col("id").alias("l_orderkey")), "l_orderkey", "left_semi")
    names = load_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    # One shuffle: the set per order also removes the repeated suppliers (an order has few lines).
    ordered = F.sort_array(F.collect_set(F.struct("s_suppkey", "s_name")))
    return (
        link.join(names, link.l_suppkey == names.s_suppkey)
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(ordered.alias("names"))
        .select("id", F.array_join("names.s_name", ", ").alias("authors"))
    )


def _document_ids(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "documents").select(F.col("doc_id").alias("id"))


def paper_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw papers without authors, one per document."""
    nr = _source_nr()
    key = F.col("doc_id").cast("string")
    return load_table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"),
        F.split_part("text", F.lit("."), F.lit(1)).alias("title"),
        F.when(nr.isin(3, 7), None)
        .when(nr == 5, "  \t")
        .otherwise(F.col("text")).alias("abstract"),
        F.when(nr != 11, F.col("source")).alias("venue"),
        F.when(nr == 13, "n/a")
        .when(nr == 17, "2015.7")
        .when(nr != 19, (1990 + F.col("n_chars") % 36).cast("string")).alias("year"),
        F.when(nr == 2, F.concat(F.lit("DOI:10.5555/"), key))
        .when(nr == 4, F.concat(F.lit("  http://doi.org/10.5555/"), key, F.lit(" ")))
        .when(nr == 6, F.lit(""))
        .when(nr != 8, F.concat(F.lit("https://doi.org/10.5555/"), key)).alias("doi"),
        F.least(F.lit(5), 1 + F.floor(F.col("n_chars") / 800)).cast("int").alias("label"),
    )


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """Raw papers; the author list is null or blank for some venues."""
    nr = F.substring("venue", 4, 10).cast("int")
    authors = F.when(nr.isin(9, 10), None).when(nr == 12, " ").otherwise(F.col("authors"))
    return (
        paper_texts(spark, folder)
        .join(authors_by_order(spark, folder, _document_ids(spark, folder)), "id", "left")
        .withColumn("authors", authors)
    )


def papers_meta(spark: SparkSession, folder: str) -> DataFrame:
    """``id, venue, year, label``: many short records."""
    orders = load_table(spark, folder, "orders")
    customer = load_table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("c_mktsegment").alias("venue"),
        F.year("o_orderdate").alias("year"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label"),
    )


def papers_meta_authors(spark: SparkSession, folder: str) -> DataFrame:
    return papers_meta(spark, folder).join(authors_by_order(spark, folder), "id", "left")


def papers_authors(spark: SparkSession, folder: str) -> DataFrame:
    """``id, year, authors`` of the many short records, without the venues' table."""
    orders = load_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    return orders.join(authors_by_order(spark, folder), "id", "left")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """``id, label`` of every order: the narrow scan the label operators need."""
    return load_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("label"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """``id, label, prediction, score``: a scored test set with errors of every size."""
    price = F.floor("o_totalprice").cast("long")
    label = F.substring("o_orderpriority", 1, 1).cast("int")
    shift = F.when(price % 10 < 6, 0).when(price % 10 < 8, 1).when(price % 10 == 8, -1).otherwise(2)
    return load_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        label.alias("label"),
        F.greatest(F.lit(1), F.least(F.lit(5), label + shift)).cast("int").alias("prediction"),
        (label + (price % 301 - 150) / F.lit(100.0)).alias("score"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return load_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding"),
        F.least(F.lit(5), 1 + F.floor(F.col("label") / 2)).cast("int").alias("label"),
    )


def crawl(spark: SparkSession, folder: str) -> DataFrame:
    """Crawl results for the documents that have a quality label."""
    docs = load_table(spark, folder, "documents").select("doc_id", "text", "source")
    known = load_table(spark, folder, "labels").select("doc_id", "quality")
    authors = authors_by_order(spark, folder, _document_ids(spark, folder))
    return (
        docs.join(known, "doc_id")
        .withColumnRenamed("doc_id", "id")
        .join(authors, "id", "left")
        .select(
            "id",
            F.concat(F.lit("10.5555/"), F.col("id").cast("string")).alias("doi"),
            F.when(F.col("quality") == 1, F.col("text")).alias("abstract"),
            F.col("authors").alias("crawled_authors"),
            F.col("source"),
        )
    )


# --- landed responses ---------------------------------------------------------------------


def _inverted_index(words: Column) -> Column:
    """Map of word to positions, built by sorting ``(word, position)`` within the row."""
    from ..functions.core import bind

    pairs = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("p"))))

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(s, i)["w"] != F.get(s, i - 1)["w"]),
        )
        return bind(
            starts,
            lambda st: F.map_from_entries(
                F.transform(
                    st,
                    lambda a, j: F.struct(
                        F.get(s, a)["w"],
                        F.transform(
                            F.slice(s, a + 1, F.coalesce(F.get(st, j + 1), n) - a),
                            lambda x: x["p"],
                        ),
                    ),
                )
            ),
        )

    return bind(pairs, runs)


def response_seed(spark: SparkSession, folder: str) -> DataFrame:
    """What the sources know about each document: text, author names and a source number."""
    return (
        load_table(spark, folder, "documents")
        .select(F.col("doc_id").alias("id"), "text", _source_nr().alias("nr"))
        .join(authors_by_order(spark, folder, _document_ids(spark, folder)), "id", "left")
        .withColumn("names", F.coalesce(F.split("authors", ", "), F.array().cast("array<string>")))
    )


def _s2_item() -> Column:
    no_authors = F.col("nr").isin(10, 11)
    names = F.when(no_authors, F.array().cast("array<string>")).otherwise(F.col("names"))
    return F.struct(
        F.when(~F.col("nr").isin(5, 6, 7, 8, 9), F.concat(F.lit(" "), "text", F.lit("\n")))
        .alias("abstract"),
        F.transform(names, lambda n: F.struct(F.concat(n, F.lit(" ")).alias("name")))
        .alias("authors"),
        F.struct(F.concat(F.lit("10.1000/"), F.col("id").cast("string")).alias("DOI"))
        .alias("externalIds"),
    )


def _crossref_item() -> Column:
    names = F.when(F.col("nr") == 7, F.array().cast("array<string>")).otherwise(F.col("names"))
    return F.struct(
        F.when(F.col("nr").isin(5, 6), "")
        .otherwise(F.concat(F.lit("<jats:p>"), "text", F.lit("</jats:p>"))).alias("abstract"),
        F.transform(
            names,
            lambda n: F.struct(
                F.split_part(n, F.lit("#"), F.lit(1)).alias("given"),
                F.split_part(n, F.lit("#"), F.lit(2)).alias("family"),
            ),
        ).alias("author"),
        F.concat(F.lit("10.2000/"), F.col("id").cast("string")).alias("DOI"),
    )


def _openalex_item() -> Column:
    words = F.split(F.regexp_replace(F.btrim("text", F.lit(" \n")), "[ \n]+", " "), " ")
    return F.struct(
        F.when(F.col("nr") != 8, _inverted_index(words)).alias("abstract_inverted_index"),
        F.transform(
            F.col("names"), lambda n: F.struct(F.struct(n.alias("display_name")).alias("author"))
        ).alias("authorships"),
        F.concat(F.lit("https://doi.org/10.3000/"), F.col("id").cast("string")).alias("doi"),
    )


def _doi_page() -> Column:
    return F.concat(
        F.lit('<html><head><meta charset="utf-8"><meta name="citation_abstract" content="'),
        F.when(F.col("nr") == 4, "").otherwise(F.replace("text", F.lit('"'), F.lit("&quot;"))),
        F.lit('"></head></html>'),
    )


def _hits(item: Column, empty: list[int]) -> Column:
    """A result list with one hit, or none for some sources."""
    some = F.array(item)
    return F.when(F.col("nr").isin(empty), F.slice(some, 1, 0)).otherwise(some)


# source -> (source numbers whose lookup fails, payload of the answer)
DOI_ANSWERS = {
    "semantic_scholar": ([0, 1, 2, 3, 4], lambda: F.to_json(_s2_item())),
    "crossref": ([0, 1, 2], lambda: F.to_json(F.struct(_crossref_item().alias("message")))),
    "openalex": ([0, 1], lambda: F.to_json(_openalex_item())),
    "doi_page": ([0], _doi_page),
}
TITLE_ANSWERS = {
    "openalex": (
        [12], lambda: F.to_json(F.struct(_hits(_openalex_item(), [0, 13]).alias("results")))
    ),
    "semantic_scholar": (
        [14], lambda: F.to_json(F.struct(_hits(_s2_item(), [1, 12]).alias("data")))
    ),
    "crossref": (
        [15],
        lambda: F.to_json(
            F.struct(F.struct(_hits(_crossref_item(), [2]).alias("items")).alias("message"))
        ),
    ),
}


def responses(spark: SparkSession, folder: str, lookup: str, source: str | None = None) -> DataFrame:
    """Answers to lookups by ``doi`` or ``title``, of one source or of all, from one scan."""
    answers = DOI_ANSWERS if lookup == "doi" else TITLE_ANSWERS
    rows = [
        F.struct(
            F.lit(name).alias("source"),
            F.lit(lookup).alias("lookup"),
            F.when(F.col("nr").isin(failed), 404).otherwise(200).alias("status"),
            payload().alias("payload"),
        )
        for name, (failed, payload) in answers.items()
        if source in (None, name)
    ]
    return response_seed(spark, folder).select("id", F.inline(F.array(*rows)))


def pages_meta(spark: SparkSession, folder: str) -> DataFrame:
    """Landing pages: the supplied ones have no named meta tag, so one is put in front.

    The form of the tag (name, quoting, attribute order) follows from the url.
    """
    url = F.col("url")
    about = F.replace(F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    quoted = F.concat(F.lit('"Page <b> at '), about, F.lit('"'))
    tag = (
        F.when(url.contains("/fr/"),
               F.concat(F.lit("<meta content="), quoted, F.lit(" name='description'/>")))
        .when(url.contains("/de/"),
              F.concat(F.lit('<meta name="citation_abstract" content=""><META NAME="dc.description" '
                             "CONTENT="), quoted, F.lit(">")))
        .when(url.contains("/es/"), F.lit("<meta name='keywords' content='x'>"))
        .otherwise(F.concat(F.lit("<meta name=description content='d'>"
                                  "<meta name=citation_abstract content="), quoted, F.lit(">")))
    )
    return load_table(spark, folder, "pages").select(
        F.col("page_id").alias("id"), "url", F.concat(tag, F.col("html")).alias("html")
    )


def llm_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Saved model replies: fenced, broken, out of range or incomplete, by order status."""
    status, price = F.col("o_orderstatus"), F.floor("o_totalprice").cast("long")
    label = F.substring("o_orderpriority", 1, 1).cast("int")
    score = label + F.when(price % 10 < 6, 0).when(price % 10 < 8, 1).otherwise(5)
    body = F.concat(F.lit('{"score": '), score.cast("string"), F.lit(', "reason": "'),
                    F.col("o_orderpriority"), F.lit('"}'))
    reply = (
        F.when(price % 10 == 9, F.concat(F.lit("Sorry: "), body))
        .when(status == "F", F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(status == "P", F.concat(F.lit("  "), body, F.lit("\n")))
        .otherwise(body)
    )
    return load_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        label.alias("Label"),
        reply.alias("reply"),
    )
