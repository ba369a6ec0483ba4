"""Sources, sinks, projections and scalar functions over records."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import core, labels as L, records as R, text as T, vectors as V
from ..operators import cleaning, evaluate, folds
from ..session import scratch_path
from ..sources import arrays, io, schemas, tables
from . import sql as Q
from .registry import query
from .sql import with_views

# The columns of the record file.
PAPER_COLUMNS = ["title", "venue", "year", "authors", "doi", "id"]


# --- sources and sinks --------------------------------------------------------------------

MISSING_WORDS = "('', 'n/a')"


@query("scan_csv", with_views(
    "SELECT " + ", ".join(
        f"CASE WHEN {c} NOT IN {MISSING_WORDS} THEN {c} END AS {c}" if c != "id" else "id"
        for c in PAPER_COLUMNS) + " FROM papers", "papers"))
def scan_csv(spark, sf):
    path = scratch_path(spark, "papers-csv")
    io.save_csv(tables.papers(spark, sf).select(*PAPER_COLUMNS), path)
    return io.load_csv(spark, path, schemas.PAPERS)


@query("sink_csv", with_views(
    "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" if c != "id" else "id" for c in PAPER_COLUMNS)
    + " FROM papers", "papers"))
def sink_csv(spark, sf):
    path = scratch_path(spark, "papers-csv")
    io.save_csv(tables.papers(spark, sf).select(*PAPER_COLUMNS), path)
    return io.load_csv(spark, path, schemas.PAPERS, missing_words=False)


@query("scan_sink_json", with_views("SELECT id, title, abstract, year, doi FROM paper_texts", "paper_texts"))
def scan_sink_json(spark, sf):
    path = scratch_path(spark, "papers-json")
    columns = ["id", "title", "abstract", "year", "doi"]
    io.save_json(tables.paper_texts(spark, sf).select(*columns), path)
    return io.load_json(spark, path, "id long, title string, abstract string, year string, doi string")


def _split_vectors(spark, sf):
    return folds.with_split(tables.vectors(spark, sf))


def _feature_sum():
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return F.round(total, 6).alias("total")


@query("scan_features", with_views(
    "SELECT id, label, CAST(len(embedding) AS INTEGER) AS width, round(list_sum(embedding), 6) AS total "
    "FROM vector_split WHERE split = 'train'", "vector_split"))
def scan_features(spark, sf):
    path = scratch_path(spark, "features")
    io.save_features(_split_vectors(spark, sf), path)
    train = io.load_features(spark, path, "train")
    return train.select("id", "label", F.size("embedding").alias("width"), _feature_sum())


@query("sink_features", with_views(
    "SELECT id, label, split, round(list_sum(embedding), 6) AS total FROM vector_split", "vector_split"))
def sink_features(spark, sf):
    path = scratch_path(spark, "features")
    io.save_features(_split_vectors(spark, sf), path)
    return io.load_features(spark, path).select("id", "label", "split", _feature_sum())


@query("scan_sink_arrays", with_views(
    "SELECT id, CAST(label AS BIGINT) AS label, CAST(len(embedding) AS INTEGER) AS width, round(list_sum(embedding), 6) AS total "
    "FROM vector_split", "vector_split"))
def scan_sink_arrays(spark, sf):
    """The vectors as .npz archives, and back by ranges of rows."""
    path = scratch_path(spark, "arrays")
    vectors = _split_vectors(spark, sf).select(
        "id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    arrays.save_arrays(vectors, path)
    return arrays.load_arrays(spark, path).select("id", "label", F.size("embedding").alias("width"), _feature_sum())


@query("sink_submission", with_views('SELECT id, prediction AS "Label" FROM predictions', "predictions"))
def sink_submission(spark, sf):
    path = scratch_path(spark, "submission")
    zero_based = tables.predictions(spark, sf).withColumn("prediction", L.to_zero_based("prediction"))
    io.save_submission(zero_based, L.to_one_based("prediction"), path)
    return io.load_csv(spark, path, schemas.SUBMISSION)


# --- projections and filters --------------------------------------------------------------


@query("drop_columns", with_views("SELECT id, venue, label FROM papers_meta_authors", "papers_meta_authors"))
def drop_columns(spark, sf):
    df = tables.papers_meta_authors(spark, sf)
    df = df.withColumns({"authors_crawl": F.col("authors"), "abstract_crawl": F.lit("")})
    return cleaning.drop_columns(df, ["authors", "year", "absent"], containing="_crawl")


@query("ensure_columns", with_views(
    "SELECT id, venue, year, label, '' AS title, '' AS abstract, '' AS authors FROM papers_meta", "papers_meta"))
def ensure_columns(spark, sf):
    return cleaning.ensure_columns(tables.papers_meta(spark, sf))


@query("fill_missing", with_views(
    f"""SELECT id, coalesce(title, '') AS title, coalesce(abstract, '') AS abstract,
      coalesce(authors, '') AS authors, coalesce(venue, 'unknown') AS venue,
      {Q.year_int('year')} AS year, doi FROM papers""", "papers"))
def fill_missing(spark, sf):
    return cleaning.fill_missing(tables.papers(spark, sf)).drop("label")


@query("blank_to_null", with_views(
    f"SELECT id, CASE WHEN NOT {Q.blank('abstract')} THEN abstract END AS abstract FROM paper_texts",
    "paper_texts"))
def blank_to_null(spark, sf):
    return tables.paper_texts(spark, sf).select("id", core.blank_to_null("abstract").alias("abstract"))


@query("conditional_update", with_views(
    f"""SELECT id, CASE WHEN {Q.blank('authors')} THEN 'by ' || coalesce(venue, '') ELSE authors END AS authors
      FROM papers""", "papers"))
def conditional_update(spark, sf):
    df = tables.papers(spark, sf).withColumn(
        "crawled_authors", F.concat(F.lit("by "), core.safe_text("venue")))
    updated = cleaning.conditional_update(df, "authors", core.is_blank("authors"), F.col("crawled_authors"))
    return updated.select("id", "authors")


@query("is_valid_result", with_views(
    f"SELECT id, length({Q.trim('title')}) > 30 AS valid FROM paper_texts", "paper_texts"))
def is_valid_result(spark, sf):
    return tables.paper_texts(spark, sf).select("id", R.is_valid_result("title").alias("valid"))


@query("is_complete_result", with_views(
    f"""SELECT id, length({Q.trim("coalesce(abstract, '')")}) > 30 AND coalesce(crawled_authors, '') <> ''
      AS complete FROM crawl""", "crawl"))
def is_complete_result(spark, sf):
    complete = R.is_complete_result("abstract", "crawled_authors")
    return tables.crawl(spark, sf).select("id", complete.alias("complete"))


@query("notna_filter", with_views(
    "SELECT id, llm_score FROM parsed_replies WHERE llm_score IS NOT NULL", "parsed_replies"))
def notna_filter(spark, sf):
    replies = tables.llm_replies(spark, sf)
    scored = replies.select("id", L.parse_llm_json("reply")["score"].alias("llm_score"))
    return scored.where(F.col("llm_score").isNotNull())


@query("mismatch_filter", with_views(
    "SELECT id, label, prediction FROM predictions WHERE label <> prediction", "predictions"))
def mismatch_filter(spark, sf):
    rows = tables.predictions(spark, sf).select("id", "label", "prediction")
    return rows.where(F.col("label") != F.col("prediction"))


@query("label_shift", with_views(
    "SELECT id, label - 1 AS zero_based, label AS one_based FROM labelled", "labelled"))
def label_shift(spark, sf):
    rows = tables.labelled(spark, sf).select("id", L.to_zero_based("label").alias("zero_based"))
    return rows.withColumn("one_based", L.to_one_based("zero_based"))


@query("label_attach", with_views(
    "SELECT m.id, m.venue, m.year, l.label FROM papers_meta m JOIN labelled l ON m.id = l.id",
    "papers_meta", "labelled"))
def label_attach(spark, sf):
    return cleaning.label_attach(tables.papers_meta(spark, sf).drop("label"), tables.labelled(spark, sf))


@query("range_clamp", with_views(
    """SELECT id, CASE WHEN s IS NULL THEN NULL WHEN s < 1 THEN 1 WHEN s > 5 THEN 5 ELSE s END AS score
      FROM (SELECT id, CAST(CASE WHEN title[1] <> '2' THEN said END AS INTEGER) AS s FROM replies)""", "replies"))
def range_clamp(spark, sf):
    said = F.get_json_object(F.regexp_extract("reply", r"\{.*\}", 0), "$.score").cast("int")
    said = F.when(~F.col("title").startswith("2"), said)  # some scores are missing
    return tables.llm_replies(spark, sf).select("id", L.clamp(said).alias("score"))


@query("column_select", with_views(
    'SELECT title, "Label", llm_score, llm_reason FROM parsed_replies', "parsed_replies"))
def column_select(spark, sf):
    parsed = tables.llm_replies(spark, sf).withColumn("r", L.parse_llm_json("reply"))
    return parsed.select("title", "Label", F.col("r.score").alias("llm_score"), F.col("r.reason").alias("llm_reason"))


@query("row_count_check", """
    SELECT doc_id AS id, 'left' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT doc_id, 'right' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def row_count_check(spark, sf):
    docs = io.load_table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    known = io.load_table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return cleaning.unmatched(docs, known)


@query("domain_check", with_views(
    """SELECT CAST(said AS INTEGER) AS "Label", count(*) AS n, said BETWEEN 1 AND 5 AS valid
      FROM replies GROUP BY said""", "replies"))
def domain_check(spark, sf):
    said = F.get_json_object(F.regexp_extract("reply", r"\{.*\}", 0), "$.score").cast("int")
    return evaluate.domain_check(tables.llm_replies(spark, sf).select(said.alias("Label")))


@query("union_splits", with_views(
    """SELECT o_orderkey AS id, year(o_orderdate)::INTEGER AS year,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderpriority[1] AS INTEGER) END AS "Label" FROM orders"""))
def union_splits(spark, sf):
    orders = io.load_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("Label"), "o_orderstatus")
    train = orders.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    test = orders.where("o_orderstatus = 'P'").drop("o_orderstatus", "Label")
    return cleaning.union_splits(train, test)


# --- scalar functions ---------------------------------------------------------------------


@query("normalize_doi", with_views(f"SELECT id, {Q.doi('doi')} AS doi FROM paper_texts", "paper_texts"))
def normalize_doi(spark, sf):
    return tables.paper_texts(spark, sf).select("id", R.normalize_doi("doi").alias("doi"))


@query("format_authors", with_views(
    f"""SELECT id, array_to_string(list_transform(list_filter(string_split(coalesce(authors, ''), ','),
      lambda a: a <> ''), lambda a: {Q.trim('a')}), ', ') AS authors FROM papers""", "papers"))
def format_authors(spark, sf):
    parts = F.split(core.safe_text("authors"), ",")
    return tables.papers(spark, sf).select("id", R.format_authors(parts).alias("authors"))


@query("build_result", with_views(
    f"""SELECT id, {Q.doi('doi')} AS doi, coalesce(abstract, '') AS abstract,
      coalesce(crawled_authors, '') AS crawled_authors FROM crawl""", "crawl"))
def build_result(spark, sf):
    return tables.crawl(spark, sf).select(*R.build_result("id", "doi", "abstract", "crawled_authors"))


@query("clean_author", "SELECT s_suppkey, " + Q.clean_author("'  ' || s_name || '  (' || s_suppkey || ').'")
       + " AS author FROM supplier")
def clean_author(spark, sf):
    raw = F.concat(F.lit("  "), "s_name", F.lit("  ("), F.col("s_suppkey").cast("string"), F.lit(")."))
    return io.load_table(spark, sf, "supplier").select("s_suppkey", T.clean_author(raw).alias("author"))


@query("normalize_author_list", with_views(
    f"SELECT id, {Q.author_list('authors')} AS authors FROM papers_meta_authors", "papers_meta_authors"))
def normalize_author_list(spark, sf):
    df = tables.papers_authors(spark, sf)
    return cleaning.normalize_authors(df).select("id", "authors")


@query("clean_text", f"SELECT doc_id AS id, {Q.clean_text('text')} AS text FROM documents")
def clean_text(spark, sf):
    docs = io.load_table(spark, sf, "documents")
    return docs.select(F.col("doc_id").alias("id"), T.clean_text("text").alias("text"))


@query("clean_pages", f"SELECT page_id AS id, {Q.clean_text('html')} AS text FROM pages")
def clean_pages(spark, sf):
    pages = io.load_table(spark, sf, "pages")
    return pages.select(F.col("page_id").alias("id"), T.clean_text("html").alias("text"))


@query("author_last_names", with_views(
    f"SELECT id, {Q.last_names('authors')} AS names FROM papers", "papers"))
def author_last_names(spark, sf):
    return tables.papers(spark, sf).select("id", T.author_last_names("authors").alias("names"))


@query("safe_text", with_views(
    "SELECT id, coalesce(CAST(year AS VARCHAR), '') AS year, coalesce(authors, '') AS authors "
    "FROM papers_meta_authors", "papers_meta_authors"))
def safe_text(spark, sf):
    df = tables.papers_authors(spark, sf)
    return df.select("id", core.safe_text("year").alias("year"), core.safe_text("authors").alias("authors"))


@query("author_count_raw", with_views(
    "SELECT id, len(string_split(coalesce(authors, 'nan'), ',')) AS n FROM papers_meta_authors",
    "papers_meta_authors"))
def author_count_raw(spark, sf):
    return tables.papers_authors(spark, sf).select(
        "id", T.author_count_raw("authors").cast("long").alias("n"))


@query("year_norm", with_views(
    "SELECT id, round((coalesce(CASE WHEN regexp_full_match(year, '[0-9]+') THEN CAST(year AS INTEGER) END, 2000)"
    " - 2000) / 30.0::DOUBLE, 6) AS year_norm FROM paper_texts", "paper_texts"))
def year_norm(spark, sf):
    return tables.paper_texts(spark, sf).select("id", F.round(R.year_norm("year"), 6).alias("year_norm"))


@query("presence_flags", with_views(
    f"""SELECT id, CAST(NOT {Q.blank('abstract')} AS INTEGER) AS has_abstract,
      CAST(len({Q.names('authors')}) > 0 AS INTEGER) AS has_authors FROM papers""", "papers"))
def presence_flags(spark, sf):
    return tables.papers(spark, sf).select(
        "id", T.presence_flag("abstract").alias("has_abstract"), T.authors_flag("authors").alias("has_authors"))


@query("prompt_sbert", with_views(
    """SELECT id, 'Title: ' || coalesce(title, '') || ' [SEP] Abstract: ' || coalesce(abstract, '')
      || ' Authors: ' || coalesce(authors, '') || ' Venue: ' || coalesce(venue, '')
      || ' Year: ' || coalesce(year, '') AS prompt FROM papers""", "papers"))
def prompt_sbert(spark, sf):
    prompt = T.prompt_sbert("title", "abstract", "authors", "venue", "year")
    return tables.papers(spark, sf).select("id", prompt.alias("prompt"))


@query("prompt_scibert", with_views(
    f"""SELECT id, {Q.trim("title")} || ' [SEP] ' || {Q.trim("coalesce(abstract, '')")}
      || ' [SEP] year: ' || {Q.trim("coalesce(year, '')")} || ', authors: '
      || array_to_string({Q.names('authors')}[1:3], ', ')
      || CASE WHEN len({Q.names('authors')}) > 3 THEN ' et al.' ELSE '' END AS prompt FROM papers""", "papers"))
def prompt_scibert(spark, sf):
    prompt = T.prompt_scibert("title", "abstract", "year", "authors")
    return tables.papers(spark, sf).select("id", prompt.alias("prompt"))


@query("prompt_venue", with_views(
    """SELECT id, 'venue: ' || coalesce(venue, '') || ' year: ' || coalesce(year, '') || ' authors: '
      || coalesce(authors, '') || ' ' || title || ' ( ' || coalesce(venue, '') || ' ) [SEP] '
      || coalesce(abstract, '') AS prompt FROM papers""", "papers"))
def prompt_venue(spark, sf):
    prompt = T.prompt_venue("venue", "year", "authors", "title", "abstract")
    return tables.papers(spark, sf).select("id", prompt.alias("prompt"))


@query("prompt_keyword", with_views(
    """SELECT id, CASE WHEN coalesce(abstract, '') <> '' THEN title || '. ' || abstract ELSE title END AS prompt
      FROM paper_texts""", "paper_texts"))
def prompt_keyword(spark, sf):
    return tables.paper_texts(spark, sf).select("id", T.prompt_keyword("title", "abstract").alias("prompt"))


@query("ordinal_targets", with_views(
    """SELECT id, array_to_string([CASE WHEN label > i THEN 1 ELSE 0 END FOR i IN [1, 2, 3, 4]], ',') AS targets
      FROM labelled""", "labelled"))
def ordinal_targets(spark, sf):
    bits = F.transform(L.ordinal_targets("label"), lambda x: x.cast("int").cast("string"))
    return tables.labelled(spark, sf).select("id", F.array_join(bits, ",").alias("targets"))


def _ordinal_logits():
    return F.transform(F.array(*[F.lit(x) for x in L.DEFAULT_CUTS]), lambda t: F.col("score") - t)


def _class_logits():
    return F.transform(F.array(*[F.lit(float(k)) for k in L.LABELS]), lambda k: -F.abs(F.col("score") - k))


EV_ORDINAL = "1 + list_sum([1 / (1 + exp(-(score - t))) FOR t IN [1.5, 2.5, 3.5, 4.5]])"
EV_SOFTMAX = ("list_sum([k * exp(-abs(score - k)) FOR k IN [1, 2, 3, 4, 5]])"
              " / list_sum([exp(-abs(score - k)) FOR k IN [1, 2, 3, 4, 5]])")


@query("ev_ordinal", with_views(f"SELECT id, round({EV_ORDINAL}, 6) AS ev FROM predictions", "predictions"))
def ev_ordinal(spark, sf):
    return tables.predictions(spark, sf).select("id", F.round(V.ev_ordinal(_ordinal_logits()), 6).alias("ev"))


@query("ev_softmax", with_views(f"SELECT id, round({EV_SOFTMAX}, 6) AS ev FROM predictions", "predictions"))
def ev_softmax(spark, sf):
    return tables.predictions(spark, sf).select("id", F.round(V.ev_softmax(_class_logits()), 6).alias("ev"))


@query("ev_blend", with_views(
    f"SELECT id, round(0.6::DOUBLE * ({EV_ORDINAL}) + 0.4::DOUBLE * ({EV_SOFTMAX}), 6) AS ev FROM predictions",
    "predictions"))
def ev_blend(spark, sf):
    ev = V.ev_blend(V.ev_ordinal(_ordinal_logits()), V.ev_softmax(_class_logits()))
    return tables.predictions(spark, sf).select("id", F.round(ev, 6).alias("ev"))


@query("apply_thresholds", with_views(
    """SELECT id, CAST(CASE WHEN id % 7 = 0 THEN NULL WHEN score < 1.5 THEN 1 WHEN score < 2.5 THEN 2
      WHEN score < 3.5 THEN 3 WHEN score < 4.5 THEN 4 ELSE 5 END AS INTEGER) AS label FROM predictions""",
    "predictions"))
def apply_thresholds(spark, sf):
    score = F.when(F.col("id") % 7 != 0, F.col("score"))  # some scores are missing
    return tables.predictions(spark, sf).select("id", L.apply_thresholds(score).alias("label"))


@query("argmax_label", with_views(
    """SELECT id, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS label
      FROM (SELECT id, [-abs(score - k) FOR k IN [1, 2, 3, 4, 5]] AS p FROM predictions)""", "predictions"))
def argmax_label(spark, sf):
    return tables.predictions(spark, sf).select("id", V.argmax_label(_class_logits()).alias("label"))


@query("parse_llm_json", with_views("SELECT id, llm_score, llm_reason FROM parsed_replies", "parsed_replies"))
def parse_llm_json(spark, sf):
    parsed = tables.llm_replies(spark, sf).select("id", L.parse_llm_json("reply").alias("r"))
    return parsed.select("id", F.col("r.score").alias("llm_score"), F.col("r.reason").alias("llm_reason"))


@query("cosine_distance", with_views(
    """SELECT a.id, round(1 - list_cosine_similarity(a.embedding, b.embedding), 6) AS distance
      FROM vectors a JOIN vectors b ON b.id = a.id + 1""", "vectors"))
def cosine_distance(spark, sf):
    rows = tables.vectors(spark, sf)
    after = rows.select((F.col("id") - 1).alias("id"), F.col("embedding").alias("other"))
    distance = F.round(V.cosine_distance("embedding", "other"), 6)
    return rows.join(after, "id").select("id", distance.alias("distance"))
