"""Time the headline queries and print one JSON line.

Every query runs three times; the first run warms up and the better of the others counts.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ebbtide.catalog.queries import QUERIES  # noqa: E402
from ebbtide.session import local_session  # noqa: E402

HEADLINE = (
    "dedupe_transactions",
    "monthly_transactions",
    "monthly_clean_usage",
    "value_anomalies",
    "expiry_match",
    "cohort_anchors",
    "usage_features",
    "transaction_features",
    "snapshot_features",
    "multi_cutoff_snapshot",
    "signal_rates",
    "exact_quantiles",
    "stratified_split",
    "average_precision",
    "pr_curve",
    "lift_table",
    "calibration_bins",
    "model_metrics",
    "event_value_deciles",
    "outreach_queue",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench", spark__driver__memory="8g")
    timings: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(min(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
