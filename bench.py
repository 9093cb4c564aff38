"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (timed runs after one
warm-up run, default 3, whose median counts; 1 for queries of more than ``LONG`` seconds), BENCH_QUERIES
(comma-separated names) steer it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.spark_queries import QUERIES, forget_runs  # noqa: E402
from palate.session import local_session  # noqa: E402

HEADLINE = [
    "bronze", "null_blank_counts", "duplicate_texts", "clean_html",
    "silver", "sentiment_counts", "silver_profile",
    "model_input", "gold_split_counts", "integrity_violations", "balanced_train",
    "research_clean", "holdout_pool",
    "aspect_sentences", "weak_labels", "polarity", "hash_sample",
    "aspect_ranking", "aspect_trend", "product_breakdown", "headlines",
    "token_counts", "vocabulary", "tfidf", "encode_sequences", "nb_params",
    "binary_metrics", "roc_auc", "multilabel_metrics", "error_review",
    "train_sentiment", "aspect_layer",
]
#: Seconds from which one timed run is enough.
LONG = 6.0


def timed(query, spark, folder: str) -> float:
    forget_runs()  # a model query trains in every run
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, folder)
        found = [timed(QUERIES[name], spark, folder)]
        while len(found) < runs and found[0] < LONG:
            found.append(timed(QUERIES[name], spark, folder))
        seconds[name] = round(statistics.median(found), 3)
        print(f"{name:24s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))


if __name__ == "__main__":
    main()
