"""Time the headline queries: BENCH_SF_DIR (data) and BENCH_CPUS (cores); prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tabmill.session import build_session
from workload.catalog import QUERIES

HEADLINE = [
    "core_models", "core_cv_predictions", "core_predictions", "model_leaderboard", "champion_by_run",
    "cv_error_by_bucket", "top_outliers", "predictions_latest_champion", "silver_layer", "gold_layer",
    "shuffled_folds", "fold_medians", "out_of_fold_univariate", "value_counts", "new_runs",
]
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(REPEATS):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(min(runs), 4)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, best of three runs each", "value": round(sum(seconds.values()), 4), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
