"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query runs once to warm up
and is then timed with its rows written to a null sink, so that no column is pruned away.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans.catalog import QUERIES  # noqa: E402
from millrace.session import local_session  # noqa: E402

HEADLINE = [
    "train_table_job", "profile_job", "histogram_all", "correlation_matrix_wide", "value_counts",
    "split_exact", "split_three_way", "shuffle_rows", "oversample", "zscore_from_train", "minmax_from_train",
    "logistic_history", "logistic_gradient_wide", "metrics_by_part", "weighted_metrics",
    "forest_job", "boosted_job", "perceptron_job",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("millrace-bench", os.environ.get("BENCH_CPUS", "8"), "16g")
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINE:
        def run(query=QUERIES[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()
        times[name] = round(timed(run), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
