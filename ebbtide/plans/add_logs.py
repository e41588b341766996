"""Add log files to a usage store and, if asked, write out the monthly tables.

    spark-submit -m ebbtide.plans.add_logs --store tables/usage_store --files raw/user_logs_2017*.csv
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ebbtide.operators.incremental import UsageStore
from ebbtide.sources import io
from ebbtide.spec import LOG_SECONDS


def add_logs(spark: SparkSession, store: str, files: list[str], output: str | None = None) -> DataFrame:
    """The usage of all files added so far; written to ``output`` without raw seconds if that is given."""
    usage = UsageStore(spark, store).add(files)
    if output:
        io.write_table(usage.drop(LOG_SECONDS), output)
    return usage


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Add log files to a usage store; files added before are left out.")
    parser.add_argument("--store", required=True)
    parser.add_argument("--files", required=True, nargs="+", help="files, folders or globs")
    parser.add_argument("--output", help="where to write the monthly table with clean seconds")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("add-logs").getOrCreate()
    add_logs(spark, args.store.rstrip("/"), args.files, args.output)


if __name__ == "__main__":
    main()
