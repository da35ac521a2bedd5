"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to the end into a sink that keeps nothing. ``BENCH_ONLY`` (comma-separated names) limits
the run, ``BENCH_FULL_MODELS=1`` adds the regressors with their default sizes.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from waymeter.plans import queries  # noqa: E402
from waymeter.session import build_session  # noqa: E402

HEADLINE = (
    "clean_trips",
    "clean_accounting",
    "dataset_issues",
    "request_quarantine",
    "temporal_features",
    "haversine_distance",
    "rare_grouped",
    "train_test_split",
    "training_features",
    "baseline_metrics",
    "metrics_by_traffic",
    "residual_histogram",
    "bucket_histogram",
    "score_responses",
    "sliding_histogram",
    "monitored_rmse",
    "ks_features",
    "drift_all_columns",
    "what_if_summary",
    "retrain_decision",
    "ridge_fit",
    "batch_scoring",
    "stream_scored",
)
# Queries whose throughput over the rows of lineitem is reported.
THROUGHPUT = ("clean_trips", "training_features", "score_responses", "ks_features")


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "waymeter-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries.registered()
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    drain(registered["request_counters"](spark, sf_dir))  # start the JVM's code paths

    seconds: dict[str, float] = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        drain(registered[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    if os.environ.get("BENCH_FULL_MODELS"):
        start = time.perf_counter()
        drain(queries.candidate_metrics(spark, sf_dir))
        seconds["all_candidates_default_sizes"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rows_per_sec": {n: round(rows / seconds[n]) for n in THROUGHPUT if n in seconds},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
