"""Validation job: checks over the built tables, a scored batch and published files.

    spark-submit -m ebbtide.plans.validate --tables tables/ --batch out/ --output-dir checks/
    spark-submit -m ebbtide.plans.validate --folder models/ --manifest models/manifest.json --output-dir checks/

Every check is written as a CSV report. The exit status is 1 if one of them finds a fault.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import checks, integrity
from ebbtide.plans import feature_build as built
from ebbtide.plans.score_batch import QUEUE, SCORES
from ebbtide.sources import io
from ebbtide.spec import ID, LABEL


class Report:
    """Writes reports to a folder and collects what is wrong in them."""

    def __init__(self, output_dir: str):
        self.output_dir = output_dir
        self.faults: list[str] = []

    def add(self, name: str, table: DataFrame, **faulty: Column) -> None:
        """Write a table of a few rows; each named condition that holds in a row is a fault."""
        path = f"{self.output_dir}/{name}"
        io.write_report(table, path, forbid=(), single_file=True)
        if faulty:
            found = table.agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in faulty.items()]).first()
            self.faults += [f"{name}: {n}" for n in faulty if found[n]]


def validate_tables(spark: SparkSession, tables: str, report: Report) -> None:
    """The monthly tables, the anchors and the snapshot that the feature build wrote."""
    usage = io.read_table(spark, f"{tables}/{built.MONTHLY_LOGS}")
    report.add("usage", checks.usage_diagnostics(usage))
    report.add("usage_by_month", checks.usage_diagnostics_by_month(usage))
    clean = io.read_table(spark, f"{tables}/{built.MONTHLY_LOGS_CLEAN}")
    report.add("clean_seconds", checks.clean_seconds_summary(clean), negative=F.col("minimum_monthly_seconds") < 0)
    tx = io.read_table(spark, f"{tables}/{built.MONTHLY_TRANSACTIONS}")
    report.add("monthly_transactions", checks.monthly_tx_summary(tx), empty=F.col("customer_month_rows") == 0)
    anchors = io.read_table(spark, f"{tables}/{built.ANCHORS}")
    report.add("anchors", checks.anchor_coverage(anchors))
    snapshot = io.read_table(spark, f"{tables}/{built.SNAPSHOT}")
    report.add("churn", checks.snapshot_churn_summary(snapshot))
    report.add(
        "cohorts", checks.snapshot_cohort_checks(snapshot),
        missing_labels=F.col("missing_labels") > 0, anchor_months=F.col("anchor_month_mismatches") > 0,
    )
    report.add("repeated_customers", checks.duplicate_keys(snapshot, ["cohort", ID]), found=F.col("duplicate_groups") > 0)
    report.add(
        "ranges", checks.feature_ranges(snapshot),
        negative_listening=F.col("negative_listening_rows") > 0, negative_payment=F.col("negative_payment_rows") > 0,
    )
    report.add("missingness", checks.feature_missingness(snapshot))


def validate_batch(spark: SparkSession, tables: str | None, batch: str, report: Report, cohort: str = "train_v2") -> None:
    """The scores and the outreach queue; with the tables at hand also the churn seen per band."""
    scored = io.read_table(spark, f"{batch}/{SCORES}")
    report.add(
        "scores", checks.scored_checks(scored),
        empty=F.col("scored_customers") == 0, repeated=F.col("unique_customers") < F.col("scored_customers"),
        missing=F.col("missing_scores") > 0, out_of_range=(F.col("min_score") < 0) | (F.col("max_score") > 1) | F.isnan("max_score"),
    )
    if tables:
        snapshot = io.read_table(spark, f"{tables}/{built.SNAPSHOT}")
        report.add("churn_by_band", checks.churn_by_band(scored, snapshot, cohort))
    contacts = io.read_raw(spark, f"{batch}/{QUEUE}")
    report.add("queue", checks.queue_checks(contacts), label=F.col("has_label"), empty=F.col("queue_rows") == 0)


def validate_files(
    spark: SparkSession, folder: str, manifest: str, report: Report, required: Sequence[str] = (), forbidden: Sequence[str] = ()
) -> None:
    """Checksums of a folder against a manifest of JSON lines with path and sha256."""
    actual = integrity.file_manifest(spark, folder)
    expected = spark.read.schema("path string, sha256 string").json(manifest)
    failures = integrity.verify_manifest(actual, expected, required, forbidden)
    report.add("files", failures, failed=F.col("failure").isNotNull())


def validate(
    spark: SparkSession, output_dir: str, tables: str | None = None, batch: str | None = None, folder: str | None = None,
    manifest: str | None = None, required: Sequence[str] = (), forbidden: Sequence[str] = (), cohort: str = "train_v2",
) -> list[str]:
    """Run the checks for which paths are given; return the faults as ``report: condition``."""
    report = Report(output_dir)
    if tables:
        validate_tables(spark, tables, report)
    if batch:
        validate_batch(spark, tables, batch, report, cohort)
    if folder and manifest:
        validate_files(spark, folder, manifest, report, required, forbidden)
    return report.faults


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Check built tables, a scored batch and published files.")
    parser.add_argument("--tables", help="folder written by feature_build")
    parser.add_argument("--batch", help="folder written by score_batch")
    parser.add_argument("--cohort", default="train_v2", help="cohort whose labels are compared with the bands")
    parser.add_argument("--folder", help="folder of published files")
    parser.add_argument("--manifest", help="JSON lines with path and sha256")
    parser.add_argument("--require", nargs="*", default=(), help="files that must be there")
    parser.add_argument("--forbid", nargs="*", default=(), help="text that no file name may hold")
    parser.add_argument("--output-dir", required=True)
    args = parser.parse_args(argv)
    if not (args.tables or args.batch or args.folder) or bool(args.folder) != bool(args.manifest):
        parser.error("give --tables, --batch, or --folder with --manifest")
    spark = SparkSession.builder.appName("validate").getOrCreate()
    faults = validate(
        spark, args.output_dir, args.tables, args.batch, args.folder, args.manifest, args.require, args.forbid, args.cohort
    )
    if faults:
        print("\n".join(faults), file=sys.stderr)
        sys.exit(1)


if __name__ == "__main__":
    main()
