"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 4).
Every query is run once to warm up and then timed as the median of three runs; all its rows are
computed and none is fetched.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from skeinworks import plans
from skeinworks.session import local_session

#: Headline queries by the table whose rows count as their input.
HEADLINE = {
    "lineitem": ["regression_metrics", "regression_ks_two_sample", "ltr_training_set", "ltr_pairwise_weights", "series_forecast"],
    "events": ["model_selection", "search_statistics", "search_statistics_by_type", "variant_comparison", "circuit_failure_state", "stream_window_averages"],
    "documents": [
        "text_clean", "text_document_metrics", "chunk_word_windows", "chunk_sentence_windows", "chunk_sections", "keyword_search",
        "bm25_search", "hybrid_search", "search_grounded", "search_alpha_sweep", "evaluate_topics", "changes_detected", "document_build",
    ],
    "embeddings": ["vector_nearest", "vector_similarity_matrix", "evaluate_ranking", "two_stage_ranking"],
    "pages": ["pages_extracted"],
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = local_session("bench", cpus)
    times, speed = {}, {}
    for table, name in [(t, q) for t, names in HEADLINE.items() for q in names]:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs[1:]), 3)
        speed[name] = round(spark.read.parquet(f"{folder}/{table}.parquet").count() / times[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians after warm-up",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": speed,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
