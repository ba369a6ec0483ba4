"""Explicit schemas; nothing is inferred at read time."""

PAPERS = "title string, venue string, year string, authors string, doi string, id long"
PAPERS_TRAIN = PAPERS + ", Label int"
CRAWL = "id long, doi string, abstract string, crawled_authors string, source string"
LABELS = "id long, label int"
SUBMISSION = "id long, Label int"
RESPONSES = "source string, id long, lookup string, status int, payload string"

# Cell texts that count as missing when a CSV file is read.
CSV_NULLS = ("", "NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None", "#N/A", "<NA>")

# The supplied tables.
TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": "l_orderkey long, l_suppkey long, l_linenumber int",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
}
