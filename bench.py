"""Headline timings: one JSON line with seconds per query.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query runs once to warm up on the smallest tables and is then timed on the
full folder; all rows are produced by a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from graniteflow import build_session
from graniteflow.plans import all_queries

HEADLINE = [
    "tokenize", "clean_documents", "tfidf", "top_terms", "embed_keywords", "stem_vocabulary", "rating_frequency",
    "box_stats", "cluster_score_table", "auc", "pearson_similarity", "knn_sweep", "precision_recall_at_t",
    "naive_subset_rmse", "bias_tables", "ols", "ridge_path", "cv_results", "mutual_info", "nmf_step",
    "lsi_explained_variance", "knn_graph", "dbscan", "kmeans_steps", "gaussian_nb", "hourly_counts_stream",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in names:
        if os.path.isdir(small):
            queries[name](spark, small).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
