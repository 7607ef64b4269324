"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS and BENCH_QUERIES (comma separated, or ``all``) change the run.
Each query is run once to warm up, then BENCH_RUNS times; the median counts. Results are computed in
full and discarded by the noop sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HEADLINE = (
    "src_reviews_json", "label_threshold", "stratified_split", "describe_stats", "label_encoder_fit",
    "metrics_weighted", "auc_rank", "tokenize_truncate", "vocab_build", "token_ids", "pad_batches",
    "nb_train", "metrics_all", "centroid_predict", "sweep_run", "score_batch", "run_tree", "best_run",
    "leaderboard", "bandit_terminate", "util_tumbling",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from reviewloom.queries import queries
    from reviewloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    catalog = queries()
    names = list(catalog) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
