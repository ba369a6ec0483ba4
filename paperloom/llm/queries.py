"""The registered queries of the text operators: each one over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..plans.registry import Query
from . import (alignment, conversations, decontaminate, exact, jaccard, langid, line_templates, mixing, pii, quality, sql,
               token_files, toxicity, urls)
from .common import documents

QUERIES: dict[str, Query] = {}


def query(name: str, text: str | None = None):
    def add(run):
        QUERIES[name] = Query(run, text)
        return run

    return add


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_language_id")
def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    part = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    held_out = F.coalesce(part == 2, F.lit(False))
    model = langid.train(docs, ~held_out)
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("row.doc_id", "lang_pred", "score").withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score")


@query("op2_quality_rules", sql.QUALITY)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    out = quality.cascade(docs, quality.ordered_rules(docs), measures=True)
    counts = [F.col(f"q.{c}").alias(c) for c in
              ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        out.select(F.col("row.doc_id").alias("doc_id"), *counts, F.col("q.rejected_by").isNull().alias("passed"))
        .withColumn("base_failed", failed).withColumn("kept", F.col("passed") & ~failed).drop("passed")
    )


@query("op3_pii")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))

    def count(kind: str) -> Column:
        number = pii.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select("row.doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


@query("op4_line_templates", sql.LINE_TEMPLATES)
def recurring_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    out = line_templates.without_recurring(docs)
    return out.select("row.doc_id", "n_lines", "n_dropped", F.col("row.text").alias("text_kept"))


@query("op5_decontamination")
def benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = decontaminate.find_passages(docs, documents(spark, folder, "benchmark"))
    return found.select("row.doc_id", (F.size("matches") > 0).alias("contaminated"),
                        F.col("matches.item_id").alias("items"), "matches")


@query("op6_mixing")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, folder))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def toxic_model(spark: SparkSession, folder: str) -> toxicity.Model:
    """Fitted on the labels of the supplied tables."""
    return toxicity.train(documents(spark, folder), documents(spark, folder, "labels"), F.col("toxic"))


@query("op7_toxicity")
def toxic_severity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    scored = toxicity.severity(docs, toxic_model(spark, folder))
    return scored.select("row.doc_id", "severity", "grade", "p_toxic", (F.col("grade") > 0).alias("toxic"))


@query("op8_url_filters")
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(documents(spark, folder, "pages"))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query("op9_ngram_jaccard")
def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.members(documents(spark, folder)).withColumnRenamed("id", "doc_id")


@query("op10_token_files")
def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_table(spark, documents(spark, folder), vocabulary())


@query("op11_conversation_repair")
def repaired_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations.damaged(documents(spark, folder, "conversations"))
    report, turns = conversations.repair(rows, present=F.col("there"))
    digests = conversations.digests(turns).withColumnRenamed("conv", "whose")
    out = report.join(digests, F.col("conv").eqNullSafe(F.col("whose")), "left")
    return out.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


@query("op12_token_alignment")
def aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    out, _ = alignment.align(documents(spark, folder), vocabulary(), vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query("op13_exact_dedup", sql.EXACT)
def exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.groups(documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
