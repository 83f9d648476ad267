"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from topicflow.registry import QUERIES
from topicflow.session import build_session

HEADLINE = (
    "scan_posts_range", "dataset_profile", "text_length_stats", "clean_text", "preprocess_posts", "stratified_sample_season",
    "embed_texts", "knn_cosine", "topic_centroids", "topic_top_words", "reduce_outliers_ctfidf", "reduce_outliers_embedding",
    "threshold_ablation", "density_cluster", "dbcv", "coherence_cv", "best_so_far", "evolution_taxonomy", "ring_samples",
    "classify_documents", "daily_drift_flags", "drift_streaks",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus, shuffle=int(cpus) if cpus.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
