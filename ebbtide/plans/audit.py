"""Audit job: inventory, coverage, expiry matches and anomalies of the raw files.

    spark-submit -m ebbtide.plans.audit --data-dir raw/ --output-dir audit/
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ebbtide.operators import profile
from ebbtide.plans.feature_build import LABEL_FILES, LOG_FILES, MEMBER_FILE, TRANSACTION_FILES
from ebbtide.sources import io
from ebbtide.spec import DEFAULT_COHORTS, LOG_SECONDS


def audit(spark: SparkSession, data_dir: str, output_dir: str) -> list[str]:
    """Write one CSV report per check over the files that exist; return what is missing, files and date columns."""
    names = [*LABEL_FILES.values(), *LOG_FILES, *TRANSACTION_FILES, MEMBER_FILE]
    present, missing = io.available(spark, {n: f"{data_dir}/{n}" for n in names}, missing="skip")

    def report(df, name: str) -> None:
        io.write_report(df, f"{output_dir}/{name}", forbid=(), single_file=True)

    tables = {n: io.read_raw(spark, p) for n, p in present.items()}
    inventory = io.source_inventory(spark, present)
    report(inventory.withColumn("first_rows", inventory["first_rows"].cast("string")), "inventory")
    dated = {n: "date" for n in LOG_FILES} | {n: "transaction_date" for n in TRANSACTION_FILES}
    for n, column in dated.items():
        if n in tables and column not in tables[n].columns:
            missing.append(f"{n}: {column}")
        elif n in tables:
            report(profile.date_coverage(tables[n], column), f"coverage_{n}")
            report(profile.rows_by_period(tables[n], column), f"months_{n}")
    labels = {c: tables[f] for c, f in LABEL_FILES.items() if f in tables}
    tx = {n: tables[n] for n in TRANSACTION_FILES if n in tables and f"{n}: transaction_date" not in missing}
    logs = {n: tables[n] for n in LOG_FILES if n in tables and f"{n}: date" not in missing}
    cohorts = [c for c in DEFAULT_COHORTS if c.name in labels]
    if tx:
        report(
            profile.date_range_by_source(tx, ["transaction_date", "membership_expire_date"]), "transaction_ranges"
        )
    if tx and cohorts:
        report(profile.expiry_match(tx, labels, cohorts), "expiry_match")
    if logs and labels:
        ids = profile.cohort_ids(labels)
        report(profile.value_anomalies(logs, LOG_SECONDS, ids), "seconds_anomalies")
        report(profile.anomaly_examples(logs, LOG_SECONDS, ids), "seconds_examples")
    return missing


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Audit the raw files before building features.")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--output-dir", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("audit").getOrCreate()
    for name in audit(spark, args.data_dir.rstrip("/"), args.output_dir):
        print(f"missing: {name}")


if __name__ == "__main__":
    main()
