"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest
from conftest import ROOT, SMALL
from pyspark.sql import functions as F

from paperloom.operators import cleaning, knn
from paperloom.plans import REGISTRY
from paperloom.sources import io, tables

NATIVE = [n for n, q in REGISTRY.items() if q.sql is not None and not n.startswith("knn")]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_native_and_without_pairs(spark, name):
    text = plan_of(REGISTRY[name].run(spark, SMALL))
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert word not in text, f"{word} in\n{text}"


def test_scan_reads_only_the_needed_columns(spark):
    text = plan_of(REGISTRY["mismatch_filter"].run(spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>" in text
    counts = plan_of(REGISTRY["value_counts"].run(spark, SMALL))
    assert "ReadSchema: struct<o_orderpriority:string>" in counts


def test_filters_reach_the_scan(spark):
    orders = io.load_table(spark, SMALL, "orders").where("o_orderstatus = 'P'")
    assert "EqualTo(o_orderstatus,P)" in plan_of(orders)


def test_split_folder_is_pruned(spark):
    from paperloom.session import scratch_path

    path = scratch_path(spark, "pruning")
    io.save_features(spark.range(4).select("id", F.when(F.col("id") < 2, "a").otherwise("b").alias("split")), path)
    text = plan_of(io.load_features(spark, path, "a"))
    assert re.search(r"PartitionFilters: \[.*split.* = a", text)


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(knn.smallest_copies(tables.vectors(spark, SMALL), 5))
    assert "TakeOrderedAndProject" in plan_of(REGISTRY["topk_venues"].run(spark, SMALL))


def test_weights_of_a_limited_vocabulary_are_not_shuffled(spark):
    text = plan_of(REGISTRY["tfidf"].run(spark, SMALL))
    assert "hashpartitioning(id" not in text and "Window" not in text


def test_the_joins_behind_the_papers_run_once(spark):
    for name in ("tfidf_concat", "features_persist"):
        assert "l_suppkey" not in plan_of(REGISTRY[name].run(spark, SMALL)), name


def test_only_orders_of_documents_are_grouped(spark):
    for name in ("parse_openalex", "priority_fallback", "batch_enrich", "title_recovery", "clean_records"):
        assert "LeftSemi" in plan_of(REGISTRY[name].run(spark, SMALL)), name


def test_authors_of_wanted_orders(spark, tmp_path):
    lines = [(1, 7), (1, 5), (1, 7), (2, 5), (3, 9), (None, 5), (4, None)]
    names = [(5, "E"), (7, "G"), (9, "I")]
    for table, rows in (("lineitem", [(*r, None) for r in lines]), ("supplier", [(*r, None, None) for r in names])):
        spark.createDataFrame(rows, io.TABLES[table]).write.parquet(str(tmp_path / f"{table}.parquet"))
    wanted = spark.createDataFrame([(1,), (1,), (3,), (4,), (None,)], "id long")
    every, some = (tables.authors_by_order(spark, str(tmp_path), w).collect() for w in (None, wanted))
    assert sorted(r for r in some) == sorted(r for r in every if r["id"] in (1, 3, 4))
    assert sorted((r["id"], r["authors"]) for r in some) == [(1, "E, G"), (3, "I")]


def test_duplicates_are_counted_in_one_scan(spark):
    text = plan_of(REGISTRY["dup_count"].run(spark, SMALL)).split("== Initial Plan ==")[-1]
    assert text.count("FileScan") == 1


def test_author_queries_read_no_customers(spark):
    assert "c_custkey" not in plan_of(REGISTRY["author_count_raw"].run(spark, SMALL))


def test_scores_shuffle_one_row_per_task(spark):
    text = plan_of(REGISTRY["qwk"].run(spark, SMALL))
    assert text.count("Exchange") == 1 and "partial_sum" in text


def test_cleaning_runs_on_a_stream(spark, tmp_path):
    papers = tables.papers(spark, SMALL)
    papers.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(papers.schema).parquet(str(tmp_path / "in"))
    query = (
        cleaning.clean_records(stream).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.collect(), key=lambda r: r["id"]) == sorted(
        cleaning.clean_records(papers).collect(), key=lambda r: r["id"])


def test_left_join_multiplies_copied_crawl_rows(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", " ")], "id long, title string, authors string")
    crawl = spark.createDataFrame([(1, "x", "T"), (1, "y", "U")], "id long, crawled_authors string, title string")
    merged = cleaning.enrich_left_join(base, crawl)
    assert merged.columns == ["id", "title", "authors", "crawled_authors", "title_crawl"] and merged.count() == 3
    out = cleaning.enrich_coalesce(merged).drop("title")
    assert sorted((r["id"], r["authors"] or "") for r in out.collect()) == [(1, "x"), (1, "y"), (2, "")]


def test_no_local_checkpoint_or_cross_join_in_the_library():
    for folder, _, files in os.walk(os.path.join(ROOT, "paperloom")):
        for name in files:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                for word in ("localCheckpoint", ".crossJoin(", "toPandas("):
                    assert word not in text, (name, word)
