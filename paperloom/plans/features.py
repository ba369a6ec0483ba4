"""Author, venue and metadata features, feature blocks, nearest neighbours."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.stopwords import english_stop_words
from ..operators import embedding, folds, knn, knn_index, metadata, models, stages
from ..session import materialize
from ..sources import tables
from . import sql as Q
from .registry import query
from .sql import with_views

AUTHORS_SQL = f"SELECT id, unnest({Q.names('authors')}) AS author FROM {{source}}"
FREQ_SQL = "SELECT author, count(*) AS freq FROM names GROUP BY author"
STATS_SQL = """SELECT p.id, coalesce(c, 0)::DOUBLE AS author_count, coalesce(m, 0)::DOUBLE AS author_freq_mean,
    coalesce(hi, 0)::DOUBLE AS author_freq_max, coalesce(lo, 0)::DOUBLE AS author_freq_min
  FROM {source} p LEFT JOIN (SELECT id, count(*) AS c, avg(freq) AS m, max(freq) AS hi, min(freq) AS lo
    FROM names n JOIN freq f ON n.author = f.author GROUP BY id) s ON p.id = s.id"""
VENUES_SQL = """SELECT venue, row_number() OVER (ORDER BY venue) - 1 AS code
  FROM (SELECT DISTINCT coalesce(venue, 'unknown') AS venue FROM papers)"""
RAW_SQL = f"""SELECT p.id, v.code::DOUBLE AS venue_encoded,
    (coalesce(CASE WHEN regexp_full_match(year, '[0-9]+') THEN CAST(year AS INTEGER) END, 2000) - 2000)
      / 30.0::DOUBLE AS year_norm,
    author_count, author_freq_mean, author_freq_max, author_freq_min,
    CASE WHEN {Q.blank('abstract')} THEN 0.0 ELSE 1.0 END::DOUBLE AS has_abstract,
    CASE WHEN author_count > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_authors
  FROM papers p JOIN venues v ON coalesce(p.venue, 'unknown') = v.venue JOIN stats s ON s.id = p.id"""
META_VIEWS = {
    "names": AUTHORS_SQL.format(source="papers"), "freq": FREQ_SQL,
    "stats": STATS_SQL.format(source="papers"), "venues": VENUES_SQL, "raw": RAW_SQL,
}


def _rounded(df, columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _raw(papers):
    venues = materialize(metadata.venue_index(papers), "venues")
    frequency = materialize(metadata.author_frequency(papers), "authors")
    return metadata.raw_metadata(papers, venues, frequency)


@query("author_frequency", with_views(
    "SELECT author, freq FROM freq", "papers_meta_authors",
    names=AUTHORS_SQL.format(source="papers_meta_authors"), freq=FREQ_SQL))
def author_frequency(spark, sf):
    return metadata.author_frequency(tables.authors_by_order(spark, sf))


@query("author_stats", with_views(
    """SELECT id, author_count, round(author_freq_mean, 6) AS author_freq_mean, author_freq_max,
      author_freq_min FROM stats""", "papers_meta_authors",
    names=AUTHORS_SQL.format(source="papers_meta_authors"), freq=FREQ_SQL,
    stats=STATS_SQL.format(source="papers_meta_authors")))
def author_stats(spark, sf):
    rows = tables.papers_authors(spark, sf).select("id", "authors")
    frequency = materialize(metadata.author_frequency(rows), "authors")
    stats = metadata.author_stats(rows, frequency)
    return _rounded(stats, ["author_freq_mean"])


@query("venue_index", with_views("SELECT venue, code FROM venues", "papers", venues=VENUES_SQL))
def venue_index(spark, sf):
    return metadata.venue_index(tables.paper_texts(spark, sf)).select("venue", "code")


@query("scaler_stats", with_views(
    "SELECT " + ", ".join(
        f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std" for c in metadata.SCALED)
    + " FROM raw", "papers", **META_VIEWS))
def scaler_stats(spark, sf):
    raw = _raw(metadata.narrow_records(tables.papers(spark, sf)))
    stats = metadata.scaler_stats(raw)
    return _rounded(stats, stats.columns)


@query("minmax_stats", with_views(
    "SELECT " + ", ".join(
        f"round(min({c}), 6) AS {c}_min, round(max({c}), 6) AS {c}_max" for c in metadata.SCALED)
    + " FROM raw", "papers", **META_VIEWS))
def minmax_stats(spark, sf):
    raw = _raw(metadata.narrow_records(tables.papers(spark, sf)))
    stats = metadata.minmax_stats(raw)
    return _rounded(stats, stats.columns)


def _scaled(c: str) -> str:
    return (f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}")


@query("metadata_features", with_views(
    f"SELECT id, {', '.join(_scaled(c) for c in metadata.SCALED)}, has_abstract, has_authors FROM raw",
    "papers", **META_VIEWS))
def metadata_features(spark, sf):
    papers = metadata.narrow_records(tables.papers(spark, sf))
    features = metadata.metadata_features(papers, metadata.fit_metadata(papers))
    return _rounded(features, metadata.SCALED)


@query("feature_concat", with_views(
    """SELECT r.id, len(v.embedding) + 8 AS width, round(list_sum(v.embedding) + venue_encoded + year_norm
      + author_count + author_freq_mean + author_freq_max + author_freq_min + has_abstract + has_authors, 6) AS total
      FROM raw r JOIN vectors v ON v.id = r.id""", "papers", "vectors", **META_VIEWS))
def feature_concat(spark, sf):
    raw = _raw(tables.papers(spark, sf))
    text = models.model_input(tables.vectors(spark, sf)).select("id", F.col("features").alias("text"))
    columns = ["text", *metadata.SCALED, *metadata.FLAGS]
    union = models.feature_concat([text, raw], columns)
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return union.select("id", F.size(values).cast("long").alias("width"), F.round(total, 6).alias("total"))


@query("feature_union")
def feature_union(spark, sf):
    """Text and metadata stages fitted on the training split: the vectors of both splits, which the fitted stages give each by itself."""
    papers = tables.papers(spark, sf)
    split = materialize(folds.with_split(papers), "split")
    model = stages.feature_union(english_stop_words()).fit(split.where("split = 'train'").drop("split"))
    train, test = (model.transform(split.where(F.col("split") == s)) for s in ("train", "test"))
    indices, values = embedding.sparse_parts("features")
    width = F.coalesce(F.unwrap_udt("features")["size"], F.size(values))
    return train.unionByName(test).select(
        "id", "label", "split", width.alias("width"), indices.alias("indices"), values.alias("values"))


@query("dense_embedding")
def dense_embedding(spark, sf):
    """Text to a dense unit vector of fixed width, without a fit: hashed terms, normalised."""
    terms = tables.paper_texts(spark, sf).select(
        "id", T.analyze("abstract", english_stop_words()).alias("terms"))
    hashed = HashingTF(numFeatures=256, inputCol="terms", outputCol="tf").transform(terms)
    unit = Normalizer(p=2.0, inputCol="tf", outputCol="unit").transform(hashed)
    return unit.select("id", vector_to_array("unit", "float32").alias("embedding"))


# --- nearest neighbours -------------------------------------------------------------------


def split_vectors(spark, sf):
    marked = materialize(folds.with_split(tables.vectors(spark, sf)), "split")
    return (marked.where(F.col("split") == s).drop("split") for s in ("train", "test"))


NEIGHBOURS_SQL = """SELECT id, neighbour_id, distance, rank, label FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour_id) AS rank FROM (
      SELECT q.id, r.id AS neighbour_id, r.label,
        round(1 - list_cosine_similarity(q.embedding, r.embedding), 9) AS distance
      FROM vector_split q JOIN vector_split r ON q.split = 'test' AND r.split = 'train'))
  WHERE rank <= 5"""
VOTE_SQL = """SELECT id, label AS prediction FROM (
    SELECT id, label, row_number() OVER (PARTITION BY id
      ORDER BY exact DESC, CASE WHEN exact > 0 THEN 0 ELSE round(inverse, 6) END DESC, label) AS r FROM (
        SELECT id, label, count(*) FILTER (distance <= 0) AS exact,
          sum(CASE WHEN distance > 0 THEN 1 / distance ELSE 0 END) AS inverse
        FROM neighbours GROUP BY id, label)) WHERE r = 1"""


@query("knn_join", with_views(
    "SELECT id, neighbour_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM neighbours",
    "vector_split", neighbours=NEIGHBOURS_SQL))
def knn_join(spark, sf):
    train, test = split_vectors(spark, sf)
    return knn.knn_join(test, train).withColumn("distance", F.round("distance", 6))


@query("knn_vote", with_views(VOTE_SQL, "vector_split", neighbours=NEIGHBOURS_SQL))
def knn_vote(spark, sf):
    train, test = split_vectors(spark, sf)
    return knn.knn_vote(knn.knn_join(test, train), train)


@query("knn_classifier", with_views(
    "SELECT s.id, s.label, vote.prediction FROM vote JOIN vector_split s ON s.id = vote.id", "vector_split",
    neighbours=NEIGHBOURS_SQL, vote=VOTE_SQL))
def knn_classifier(spark, sf):
    train, test = split_vectors(spark, sf)
    return test.select("id", "label").join(knn.knn_classifier(train, test), "id")


@query("knn_index")
def knn_index_search(spark, sf):
    """The five nearest of all vectors for every id divisible by 20, by inverted lists over all rows."""
    vectors = materialize(tables.vectors(spark, sf).select("id", "embedding"), "vectors")
    index = knn_index.build(vectors)
    queries = vectors.where(F.col("id") % 20 == 0)
    probes = knn_index.calibrated_probes(index, queries, vectors)
    return knn_index.search(index, queries, vectors, probes=probes).withColumn("distance", F.round("distance", 6))
