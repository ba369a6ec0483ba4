"""Tokens, n-grams, document frequencies, TF-IDF and keywords."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stopwords import english_stop_words
from ..operators import embedding, stages, terms
from ..session import materialize
from ..sources import io, tables
from . import sql as Q
from .registry import query
from .sql import with_views


def _documents(spark, sf):
    return io.load_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")


@query("tokenize_words", rf"SELECT doc_id AS id, array_to_string({Q.tokens('text')}, ' ') AS tokens FROM documents")
def tokenize_words(spark, sf):
    return _documents(spark, sf).select("id", F.array_join(T.tokenize_words("text"), " ").alias("tokens"))


@query("tokenize_conversations", f"""
    SELECT conv_id, turn, len({Q.tokens('text')}) AS n FROM conversations""")
def tokenize_conversations(spark, sf):
    rows = io.load_table(spark, sf, "conversations")
    return rows.select("conv_id", "turn", F.size(T.tokenize_words("text")).cast("long").alias("n"))


@query("remove_stop_words", f"""
    SELECT doc_id AS id, array_to_string({Q.content_tokens('text')}, ' ') AS tokens FROM documents""")
def remove_stop_words(spark, sf):
    kept = T.remove_stop_words(T.tokenize_words("text"), english_stop_words())
    return _documents(spark, sf).select("id", F.array_join(kept, " ").alias("tokens"))


@query("ngrams_1_2", f"""
    SELECT id, array_to_string(list_concat(t, {Q.bigrams('t')}), '|') AS ngrams
    FROM (SELECT doc_id AS id, {Q.content_tokens('text')} AS t FROM documents)""")
def ngrams_1_2(spark, sf):
    terms_ = T.analyze("text", english_stop_words())
    return _documents(spark, sf).select("id", F.array_join(terms_, "|").alias("ngrams"))


def _terms_sql(tokens: str, source: str, bigrams: bool = True) -> str:
    """id, term, tf"""
    listed = f"list_concat(t, {Q.bigrams('t')})" if bigrams else "t"
    return f"""SELECT id, term, count(*) AS tf FROM (
      SELECT id, unnest({listed}) AS term FROM (SELECT id, {tokens} AS t FROM {source})) GROUP BY id, term"""


def _vocab_sql(terms_view: str, source: str, min_df: int, max_df: float, limit: int | None) -> str:
    top = f"ORDER BY tf DESC, term LIMIT {limit}" if limit else ""
    return f"""SELECT term, df, tf, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
      FROM (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM {terms_view} GROUP BY term),
        (SELECT count(*) AS n FROM {source})
      WHERE df >= {min_df} AND df <= {max_df} * n {top}"""


def _weights_sql(terms_view: str, vocab: str) -> str:
    return f"""SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight
      FROM (SELECT id, t.term, t.tf * idf AS raw FROM {terms_view} t JOIN {vocab} v ON t.term = v.term)"""


@query("document_frequency", with_views(
    "SELECT term, df, tf FROM vocab", "paper_texts",
    terms=_terms_sql(Q.content_tokens("abstract"), "paper_texts"),
    vocab=_vocab_sql("terms", "paper_texts", 2, 0.9, None)))
def document_frequency(spark, sf):
    papers = terms.spread(tables.paper_texts(spark, sf).select("id", "abstract"))
    seen = terms.record_terms(papers, "abstract", english_stop_words())
    n_docs = tables.paper_texts(spark, sf).agg(F.count("*")).scalar()
    return terms.prune(terms.document_frequency(seen), n_docs, 2, 0.9).select("term", "df", "tf")


@query("vocab_topn", with_views(
    "SELECT term, tf FROM vocab", "paper_texts",
    terms=_terms_sql(Q.content_tokens("title"), "paper_texts"),
    vocab=_vocab_sql("terms", "paper_texts", 2, 0.9, 3000)))
def vocab_topn(spark, sf):
    papers = tables.paper_texts(spark, sf)
    seen = terms.record_terms(papers, "title", english_stop_words())
    return terms.vocabulary(papers, seen, 2, 0.9, 3000).select("term", "tf")


@query("tfidf", with_views(
    "SELECT id, term, round(weight, 6) AS weight FROM weights", "paper_texts",
    terms=_terms_sql(Q.content_tokens("abstract"), "paper_texts"),
    vocab=_vocab_sql("terms", "paper_texts", 2, 0.9, 8000),
    weights=_weights_sql("terms", "vocab")))
def tfidf(spark, sf):
    weights = terms.tfidf(tables.paper_texts(spark, sf), "abstract", stop_words=english_stop_words(),
                          min_df=2, max_df=0.9, max_features=8000)
    return weights.withColumn("weight", F.round("weight", 6))


@query("tfidf_all_terms", with_views(
    "SELECT id, term, round(weight, 6) AS weight FROM weights",
    source="SELECT o_orderkey AS id, o_orderpriority || ' ' || o_orderstatus || ' clerk ' || o_custkey AS t FROM orders",
    terms=_terms_sql(Q.content_tokens("t"), "source"),
    vocab=_vocab_sql("terms", "source", 1, 1.0, None),
    weights=_weights_sql("terms", "vocab")))
def tfidf_all_terms(spark, sf):
    """No vocabulary limit: the skew-safe shuffled join, with terms that are in every record."""
    text = F.concat_ws(" ", "o_orderpriority", "o_orderstatus", F.lit("clerk"), F.col("o_custkey").cast("string"))
    rows = io.load_table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), text.alias("t"))
    weights = terms.tfidf(rows, "t", stop_words=english_stop_words())
    return weights.withColumn("weight", F.round("weight", 6))


@query("tfidf_author", with_views(
    "SELECT id, term, round(weight, 6) AS weight FROM weights", "papers_meta_authors",
    terms=_terms_sql(Q.tokens(Q.last_names("authors")), "papers_meta_authors", bigrams=False),
    vocab=_vocab_sql("terms", "papers_meta_authors", 1, 1.0, 1500),
    weights=_weights_sql("terms", "vocab")))
def tfidf_author(spark, sf):
    weights = terms.tfidf(tables.papers_authors(spark, sf), T.author_last_names("authors"),
                          bigrams=False, max_features=1500)
    return weights.withColumn("weight", F.round("weight", 6))


@query("tfidf_concat", with_views(
    " UNION ALL ".join(
        f"SELECT '{b}' AS block, id, term, round(weight, 6) AS weight FROM w_{b}"
        for b in ("title", "abstract", "author")),
    "papers",
    t_title=_terms_sql(Q.content_tokens("title"), "papers"),
    t_abstract=_terms_sql(Q.content_tokens("abstract"), "papers"),
    t_author=_terms_sql(Q.tokens(Q.last_names("authors")), "papers", bigrams=False),
    v_title=_vocab_sql("t_title", "papers", 2, 0.9, 3000),
    v_abstract=_vocab_sql("t_abstract", "papers", 2, 0.9, 8000),
    v_author=_vocab_sql("t_author", "papers", 1, 1.0, 1500),
    w_title=_weights_sql("t_title", "v_title"),
    w_abstract=_weights_sql("t_abstract", "v_abstract"),
    w_author=_weights_sql("t_author", "v_author")))
def tfidf_concat(spark, sf):
    blocks = terms.tfidf_blocks(tables.papers(spark, sf), english_stop_words())
    return blocks.select("block", "id", "term", F.round("weight", 6).alias("weight"))


@query("topk_keywords", with_views(
    """SELECT p.id, coalesce(string_agg(term, '|' ORDER BY r) FILTER (r <= 5), '') AS keywords
      FROM paper_texts p LEFT JOIN ranked k ON p.id = k.id GROUP BY p.id""", "paper_texts",
    prompts="""SELECT id, CASE WHEN coalesce(abstract, '') <> '' THEN title || '. ' || abstract ELSE title END AS t
      FROM paper_texts""",
    terms=_terms_sql(Q.content_tokens("t"), "prompts"),
    vocab=_vocab_sql("terms", "prompts", 1, 1.0, None),
    ranked="""SELECT id, t.term, row_number() OVER (PARTITION BY id ORDER BY round(t.tf * idf, 9) DESC, t.term) AS r
      FROM terms t JOIN vocab v ON t.term = v.term"""))
def topk_keywords(spark, sf):
    words = terms.topk_keywords(tables.paper_texts(spark, sf), english_stop_words())
    return words.withColumn("keywords", F.array_join("keywords", "|"))


# --- learned vectors ----------------------------------------------------------------------


def _latent(spark, sf):
    """Vectors of the abstracts, learned from their TF-IDF weights."""
    papers = terms.spread(tables.paper_texts(spark, sf).select("id", "abstract"))
    block = stages.TfidfBlock(inputCol="abstract", outputCol="weights", maxFeatures=8000, stopWords=list(english_stop_words()))
    # The fit and the transform both read the weights, which cost more than the steps; they are found once.
    weighted = materialize(block.fit(papers).transform(papers).select("id", "weights"), "weights")
    found = embedding.LatentTerms("weights", steps=12, tolerance=1e-4).fit(weighted).transform(weighted)
    return materialize(found.select("id", "embedding"), "vectors")


@query("latent_embedding")
def latent_embedding(spark, sf):
    return _latent(spark, sf).select("id", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))


@query("latent_embedding_norms", with_views(
    """SELECT p.id, CASE WHEN k.id IS NULL THEN 0 ELSE 1 END::DOUBLE AS norm
      FROM paper_texts p LEFT JOIN (SELECT DISTINCT id FROM terms JOIN vocab ON terms.term = vocab.term) k ON k.id = p.id""", "paper_texts",
    terms=_terms_sql(Q.content_tokens("abstract"), "paper_texts"),
    vocab=_vocab_sql("terms", "paper_texts", 2, 0.9, 8000)))
def latent_embedding_norms(spark, sf):
    """Unit length where a record has a term of the vocabulary, zero elsewhere."""
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    return _latent(spark, sf).select("id", F.round(F.sqrt(square), 6).alias("norm"))
