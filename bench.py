"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_text", "clean_records", "missing_report", "dup_count", "length_stats", "priority_fallback",
    "title_recovery", "author_stats", "metadata_features", "document_frequency", "tfidf",
    "topk_keywords", "stratified_kfold", "classification_report", "qwk", "threshold_search", "knn_join",
    "logreg",
]


def main() -> None:
    from paperloom.plans import REGISTRY
    from paperloom.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "bench")
    # One untimed query starts the executors and loads the classes.
    REGISTRY["value_counts"].run(spark, folder).collect()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The noop sink computes every row and column and writes nothing.
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
