"""Feature build job: raw CSV files to monthly tables, anchors and snapshots.

    spark-submit -m ebbtide.plans.feature_build --data-dir raw/ --output-dir tables/
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ebbtide.operators import checks, profile, rollup, snapshot
from ebbtide.sources import io
from ebbtide.spec import (
    DEFAULT_COHORTS,
    ID,
    LABEL,
    LOG_COUNTERS,
    LOG_SECONDS,
    MEMBER_COLUMNS,
    Cohort,
)

# Names of the raw files in the data folder.
LABEL_FILES = {"train": "train.csv", "train_v2": "train_v2.csv"}
LOG_FILES = ("user_logs.csv", "user_logs_v2.csv")
TRANSACTION_FILES = ("transactions.csv", "transactions_v2.csv")
MEMBER_FILE = "members_v3.csv"

MONTHLY_LOGS = "logs_monthly"
MONTHLY_LOGS_CLEAN = "logs_monthly_clean"
MONTHLY_TRANSACTIONS = "transactions_monthly"
ANCHORS = "cohort_anchors"
SNAPSHOT = "snapshot_features"


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    io.write_table(df, path)
    return io.read_table(spark, path)


def build_features(
    spark: SparkSession,
    labels: Mapping[str, str],
    logs: Sequence[str],
    transactions: Sequence[str],
    members: str,
    output_dir: str,
    cohorts: Sequence[Cohort] = DEFAULT_COHORTS,
) -> DataFrame:
    """Write the monthly tables, the anchors and the snapshot; return the snapshot.

    Logs are scanned once. Raw and clean seconds come from the same aggregation;
    the raw ones are kept in a table of their own for audits. Each table is
    stored before the next one reads it, so a lost executor costs one step.
    """
    named = {f"labels {n}": p for n, p in labels.items()}
    named |= {f"logs {i}": p for i, p in enumerate(logs)}
    named |= {f"transactions {i}": p for i, p in enumerate(transactions)}
    io.available(spark, {**named, "members": members}, missing="error")

    label_tables = {n: io.read_raw(spark, p, [ID, LABEL]) for n, p in labels.items()}
    ids = profile.cohort_ids(label_tables)
    log_columns = [ID, "date", *LOG_COUNTERS, LOG_SECONDS]
    raw_logs = [io.read_raw(spark, p, log_columns) for p in logs]
    all_logs = raw_logs[0]
    for more in raw_logs[1:]:
        all_logs = all_logs.unionByName(more)
    usage = _stored(
        spark,
        rollup.restrict_to(rollup.monthly_clean_usage(all_logs, keep_raw=True), ids),
        f"{output_dir}/{MONTHLY_LOGS}",
    )
    clean = _stored(spark, usage.drop(LOG_SECONDS), f"{output_dir}/{MONTHLY_LOGS_CLEAN}")

    raw_tx = [io.read_raw(spark, p) for p in transactions]
    tx_monthly = _stored(
        spark,
        rollup.restrict_to(rollup.monthly_transactions(rollup.dedupe_events(*raw_tx)), ids),
        f"{output_dir}/{MONTHLY_TRANSACTIONS}",
    )
    labelled = rollup.cohort_labels(label_tables, cohorts)
    anchors = _stored(
        spark,
        rollup.cohort_anchors(labelled, rollup.stack_events(*raw_tx)),
        f"{output_dir}/{ANCHORS}",
    )
    return _stored(
        spark,
        snapshot.build_snapshot(
            anchors,
            clean,
            tx_monthly,
            io.read_raw(spark, members, MEMBER_COLUMNS),
            before=max(c.target for c in cohorts),
        ),
        f"{output_dir}/{SNAPSHOT}",
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build customer-month tables and point-in-time snapshots.")
    parser.add_argument("--data-dir", required=True, help="folder with the raw CSV files")
    parser.add_argument("--output-dir", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("feature-build").getOrCreate()
    at = args.data_dir.rstrip("/")
    built = build_features(
        spark,
        {n: f"{at}/{f}" for n, f in LABEL_FILES.items()},
        [f"{at}/{f}" for f in LOG_FILES],
        [f"{at}/{f}" for f in TRANSACTION_FILES],
        f"{at}/{MEMBER_FILE}",
        args.output_dir,
    )
    checks.snapshot_churn_summary(built).show()


if __name__ == "__main__":
    main()
