"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS the runs per
query (the fastest counts, so that the first, cold one does not) and BENCH_QUERIES, if set, other query names, comma-separated.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tabwright.checks.queries import QUERIES
from tabwright.session import local_session

HEADLINE = [
    "j1_pit_lookup",
    "j2_training_set",
    "j3_late_label_evaluation",
    "a2_class_metrics",
    "a3_classifier_evaluation",
    "a4_confusion_matrix",
    "a5_log_loss",
    "r1_hash_split",
    "f2_one_hot",
    "e1_overview",
    "e2_numeric_stats",
    "e3_quantiles",
    "e4_histogram",
    "e5_categorical_stats",
    "c1_pearson",
    "c2_spearman",
    "c3_kendall",
    "c4_phi_k",
    "c5_cramers_v",
    "c6_auto",
    "l2_current_aliases",
    "l3_duel_decision",
    "m1_batch_score",
    "t1_boosted_trees",
    "x1_stream_score",
]


def timed(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, "bench", spark__sql__warehouse__dir=folder)
    spark.sparkContext.setLogLevel("ERROR")
    timed("a1_row_count", spark, sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = round(min(timed(name, spark, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
