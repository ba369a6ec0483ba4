"""Terms, document frequencies and TF-IDF weights as tables keyed by record id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T
from ..session import materialize
from .skew import lookup_join

# A vocabulary up to this many terms is small enough to send to every task.
BROADCAST_TERMS = 100_000

# Terms whose weights are known within the row when keywords are chosen.
FREQUENT_TERMS = 20_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to as many tasks as the session has cores, where its source has fewer parts.

    For work that costs far more than moving the rows. A large table has more parts and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def record_terms(df: DataFrame, text: Column | str, stop_words: Sequence[str] = (),
                 bigrams: bool = True, id_col: str = "id") -> DataFrame:
    """``id, term, tf``: counted inside the row, so this is a narrow step."""
    counted = T.term_counts(T.analyze(text, stop_words, bigrams))
    return df.select(F.col(id_col).alias("id"), F.inline(counted))


def document_frequency(terms: DataFrame) -> DataFrame:
    """``term, df, tf``: records and occurrences per term."""
    return terms.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


def prune(frequency: DataFrame, n_docs: Column, min_df: int = 1, max_df: float = 1.0) -> DataFrame:
    """Keep terms in at least ``min_df`` records and at most a ``max_df`` share of them."""
    counted = frequency.withColumn("n_docs", n_docs)
    return counted.where((F.col("df") >= min_df) & (F.col("df") <= F.col("n_docs") * max_df))


def vocab_topn(vocabulary: DataFrame, n: int) -> DataFrame:
    """The n terms with most occurrences; equal ones in term order."""
    return vocabulary.orderBy(F.desc("tf"), "term").limit(n)


def vocabulary(df: DataFrame, terms: DataFrame, min_df: int = 1, max_df: float = 1.0,
               max_features: int | None = None) -> DataFrame:
    """``term, df, tf, n_docs, idf`` with the smoothed idf ``ln((1+n)/(1+df)) + 1``."""
    n_docs = df.agg(F.count("*")).scalar()
    kept = prune(document_frequency(terms), n_docs, min_df, max_df)
    if max_features is not None:
        kept = vocab_topn(kept, max_features)
    return kept.withColumn("idf", F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)


def weigh(terms: DataFrame, vocab: DataFrame, max_features: int | None) -> DataFrame:
    """``id, term, raw`` with ``raw = tf * idf``.

    A vocabulary with a limit is broadcast. Without a limit it grows with the corpus, so it is
    written once, the join is shuffled and the terms that occur in many records are spread.
    """
    if max_features is not None and max_features <= BROADCAST_TERMS:
        joined = terms.join(F.broadcast(vocab.select("term", "idf")), "term")
    else:
        table = materialize(vocab.select("term", "idf", "df"), "vocabulary")
        joined = lookup_join(terms, table, "term", "df", "id", "inner")
    return joined.select("id", "term", (F.col("tf") * F.col("idf")).alias("raw"))


def normalise(weights: DataFrame) -> DataFrame:
    """Divide by the Euclidean norm of the record (a partition is one record's terms)."""
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))
    return weights.select("id", "term", (F.col("raw") / norm).alias("weight"))


def _idf(n_docs: int, df: Column) -> Column:
    return F.log((1 + F.lit(n_docs)) / (1 + df)) + 1


def _marks(term: Column | str) -> list[Column]:
    """A term in 96 bits: two different hashes."""
    return [F.xxhash64(term).alias("m1"), F.hash(term).alias("m2")]


def _place(text: Column | str) -> Column:
    """One of 65,536 numbers for a text: enough to find it again, and short in a shuffle."""
    return F.pmod(F.hash(text), F.lit(1 << 16))


def counted_marks(train: DataFrame, text: Column | str, terms: Column, with_tf: bool = True) -> DataFrame:
    """``m1, m2, df, tf, at``: records and occurrences per term, and the place of a text that holds it.

    Keys and sums have a fixed width, which is several times faster to group than texts, and nothing is sorted within
    the record: each term is listed once for every occurrence and once more for the record.
    """
    rows = train.select(terms.alias("_terms"), _place(text).alias("at"))
    once = F.array_distinct("_terms")
    if not with_tf:
        listed = rows.select("at", F.explode(once).alias("term"))
        return listed.groupBy(*_marks("term")).agg(F.count("*").alias("df"), F.max("at").alias("at"))
    listed = rows.select("at", F.size("_terms").alias("n"), F.posexplode(F.concat("_terms", once)).alias("k", "term"))
    occurs = (F.col("k") < F.col("n")).cast("long")
    return listed.groupBy(*_marks("term")).agg(
        F.sum(1 - occurs).alias("df"), F.sum(occurs).alias("tf"), F.max("at").alias("at"))


def _spelled(train: DataFrame, text: Column | str, terms: Column, chosen: DataFrame) -> DataFrame:
    """``chosen`` (a bounded number of marks) with ``term``, read from the texts that hold them."""
    # Only the texts that are looked for are cut into terms.
    holds = train.withColumn("at", _place(text)).join(F.broadcast(chosen.select("at").distinct()), "at", "left_semi")
    found = holds.select(F.explode(terms).alias("term")).select("term", *_marks("term"))
    return found.join(F.broadcast(chosen), ["m1", "m2"]).dropDuplicates(["m1", "m2"])


def limited_vocabulary(train: DataFrame, text: Column | str, terms: Column, min_df: int, max_df: float,
                       max_features: int) -> list[tuple[str, float]]:
    """``term, idf`` of the ``max_features`` terms with most occurrences, in term order; equal ones in term order."""
    n_docs = train.count()
    kept = prune(counted_marks(train, text, terms), F.lit(n_docs), min_df, max_df)
    # Marks know no term order, so the terms that tie with the last one come too.
    room = 4 * max_features
    first = materialize(kept.orderBy(F.desc("tf"), "m1", "m2").limit(room), "terms")
    rows = _spelled(train, text, terms, first).select("term", "tf", _idf(n_docs, F.col("df")).alias("idf")).collect()
    best = sorted(rows, key=lambda r: (-r["tf"], r["term"]))
    if len(best) == room and best[-1]["tf"] == best[max_features - 1]["tf"]:
        # More ties than room: all terms as texts.
        seen = train.select(F.inline(T.term_counts(terms)))
        best = vocabulary(train, seen, min_df, max_df, max_features).select("term", "idf").collect()
    return sorted((r["term"], r["idf"]) for r in best[:max_features])


def _word(source: DataFrame, words: list[str], at: str) -> Column:
    """The word with number ``at``."""
    listed = source.sparkSession.createDataFrame([(words,)], "x array<string>").select("x").scalar()
    return F.get(listed, F.col(at))


def _weighted(source: DataFrame, terms: Column, words: list[str], idf: list[float]) -> DataFrame:
    """``id, term, weight`` of the records of ``source``: terms are looked up by hash, and the norm is taken in the
    row, so nothing is shuffled."""
    found = CountVectorizerModel.from_vocabulary(words, inputCol="_terms", outputCol="_counts").transform(
        source.select("id", terms.alias("_terms")))
    raw = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_raw").transform(found)
    unit = Normalizer(p=2.0, inputCol="_raw", outputCol="_unit").transform(raw).select("id", F.unwrap_udt("_unit").alias("u"))
    # The words are looked up after the rows are dealt out: a list of all words in each row would be copied with it.
    entries = unit.select("id", F.inline(F.arrays_zip("u.indices", "u.values"))).toDF("id", "at", "weight")
    return entries.select("id", _word(source, words, "at").alias("term"), "weight")


def tfidf(train: DataFrame, text: Column | str, *, test: DataFrame | None = None,
          stop_words: Sequence[str] = (), bigrams: bool = True, min_df: int = 1,
          max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """``id, term, weight``: vocabulary and idf from ``train``, weights for ``test`` or itself.

    With a limit of at most ``BROADCAST_TERMS`` the vocabulary is a bounded model that every task
    gets, and each record is weighted by itself. Without one the weights are joined and shuffled.
    """
    train = spread(train)
    test = None if test is None else spread(test)
    seen = record_terms(train, text, stop_words, bigrams)
    vocab = vocabulary(train, seen, min_df, max_df, max_features)
    source = train if test is None else test
    if max_features is None or max_features > BROADCAST_TERMS:
        rows = seen if test is None else record_terms(test, text, stop_words, bigrams)
        return normalise(weigh(rows, vocab, max_features))
    terms = T.analyze(text, stop_words, bigrams)
    if bigrams:
        rows = limited_vocabulary(train, text, terms, min_df, max_df, max_features)
    else:
        # Words are few. At most ``max_features`` rows come to the driver: they become the model that every task gets.
        rows = [(r["term"], r["idf"]) for r in vocab.select("term", "idf").orderBy("term").collect()]
    if not rows:
        return source.select("id", F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    return _weighted(source, terms, [w for w, _ in rows], [x for _, x in rows])


def tfidf_blocks(df: DataFrame, stop_words: Sequence[str], title_features: int = 3000,
                 abstract_features: int = 8000, author_features: int = 1500) -> DataFrame:
    """``block, id, term, weight``: the title, abstract and author blocks side by side."""
    # Each block passes over the records twice; the joins behind them run once.
    df = materialize(df.select("id", "title", "abstract", "authors"), "blocks")
    common = {"stop_words": stop_words, "min_df": 2, "max_df": 0.9}
    blocks = {
        "title": tfidf(df, "title", max_features=title_features, **common),
        "abstract": tfidf(df, "abstract", max_features=abstract_features, **common),
        "author": tfidf(df, T.author_last_names("authors"), bigrams=False,
                        max_features=author_features),
    }
    out = None
    for name, block in blocks.items():
        named = block.withColumn("block", F.lit(name))
        out = named if out is None else out.unionByName(named)
    return out


def _likely(texts: DataFrame, terms: Column, k: int) -> DataFrame:
    """``id, term, raw`` of the terms that can be among the k best of their record.

    The weights of the most frequent terms are known in the row. The idf of any other term lies between that of the last
    of them and that of a term of one record; it leaves where even the higher weight is below the k-th best lower one.
    Only what is left is joined with the counts.
    """
    n_docs = texts.count()
    # Written once: the most frequent terms and the join read them. A term that is not there has one record.
    counts = materialize(counted_marks(texts, "text", terms, with_tf=False).where("df > 1"), "terms")
    top = materialize(counts.orderBy(F.desc("df"), "m1", "m2").limit(FREQUENT_TERMS), "frequent")
    # At most FREQUENT_TERMS rows come to the driver.
    frequent = _spelled(texts, "text", terms, top).select("term", "df", _idf(n_docs, F.col("df")).alias("idf"))
    frequent = frequent.orderBy("term").collect()
    words, idf = [r["term"] for r in frequent] or [""], [r["idf"] for r in frequent] or [1.0]
    counted = CountVectorizerModel.from_vocabulary(words, inputCol="_terms", outputCol="_counts").transform(
        texts.where("id IS NOT NULL").select("id", terms.alias("_terms")))
    raw = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_raw").transform(counted)
    others = StopWordsRemover(inputCol="_terms", outputCol="_rest", stopWords=words, caseSensitive=True).transform(raw)
    raws = F.unwrap_udt("_raw")
    rows = others.select("id", raws["indices"].alias("at"), raws["values"].alias("raw"), T.term_counts("_rest").alias("rest"))
    low, high = _idf(n_docs, F.lit(min((r["df"] for r in frequent), default=1))), _idf(n_docs, F.lit(1))
    sure = F.concat("raw", F.transform("rest", lambda x: x["tf"] * low))
    # The margin is wider than the rounding of weights.
    floor = F.coalesce(F.get(F.sort_array(sure, False), F.lit(k - 1)), F.lit(0.0)) - 1e-6
    rows = rows.withColumn("floor", floor)
    none = {t: F.lit(None).cast(t) for t in ("int", "string", "double")}
    known = F.zip_with("at", "raw", lambda a, w: F.struct(
        a.alias("at"), none["string"].alias("term"), none["int"].alias("tf"), w.alias("raw")))
    unknown = F.transform("rest", lambda x: F.struct(
        none["int"].alias("at"), x["term"].alias("term"), x["tf"].alias("tf"), none["double"].alias("raw")))
    likely = F.concat(F.filter(known, lambda x: x["raw"] >= F.col("floor")),
                      F.filter(unknown, lambda x: x["tf"] * high >= F.col("floor")))
    found = rows.select("id", F.inline(likely))
    m1, m2 = _marks("term")
    # A known weight looks up nothing; its keys are spread by the record.
    found = found.select(
        "id", F.coalesce("term", _word(texts, words, "at")).alias("term"), "tf", "raw",
        F.when(F.col("raw").isNull(), m1).otherwise(F.xxhash64("id")).alias("m1"), F.when(F.col("raw").isNull(), m2).alias("m2"))
    joined = found.join(counts.select("m1", "m2", "df"), ["m1", "m2"], "left")
    return joined.select("id", "term", F.coalesce("raw", F.col("tf") * _idf(n_docs, F.coalesce("df", F.lit(1)))).alias("raw"))


def topk_keywords(df: DataFrame, stop_words: Sequence[str], k: int = 5) -> DataFrame:
    """``id, keywords``: the k terms of highest tf-idf per record, best first; [] for no text."""
    texts = spread(df.select("id", T.prompt_keyword("title", "abstract").alias("text")))
    weights = _likely(texts, T.analyze("text", stop_words), k).withColumn("raw", F.round("raw", 9))
    order = Window.partitionBy("id").orderBy(F.desc("raw"), "term")
    top = weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked = F.sort_array(F.collect_list(F.struct("rank", "term")))
    words = top.groupBy("id").agg(F.transform(ranked, lambda x: x["term"]).alias("keywords"))
    none = F.array().cast("array<string>")
    return df.select("id").join(words, "id", "left").select(
        "id", F.coalesce("keywords", none).alias("keywords")
    )


