"""Batch scoring job: contract, scores, ranks, bands, score table and outreach queue.

    spark-submit -m ebbtide.plans.score_batch --input snapshot/ --model model/ --output-dir out/
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import checks, queue
from ebbtide.operators.models import ChurnModel
from ebbtide.session import durable
from ebbtide.sources import io
from ebbtide.spec import ID, QUEUE_SIGNALS

# Fixed values of the public contract.
SCORES = "customer_risk_scores"
QUEUE = "outreach_queue"


def score_batch(
    spark: SparkSession,
    input_path: str,
    model_path: str,
    output_dir: str,
    cohort: str = "train_v2",
    share: float = 0.10,
) -> DataFrame:
    """Write ``customer_risk_scores`` and ``outreach_queue``; return customers per band.

    Only the id and the model's features are read, never the label. Scores are
    ranked once and read back from the stored table for the queue.
    """
    queue.check_share(share)
    table = io.read_table(spark, input_path)
    if cohort.lower() != "none":
        table = table.where(F.col("cohort") == cohort)
    batch = checks.enforce_contract(table)
    # Range partitioning samples its input, which would run the model a second time.
    scored = durable(ChurnModel.load(spark, model_path).score(batch).select(ID, "risk_score"))
    scored = checks.enforce_contract(scored, required=(ID, "risk_score"))
    banded = queue.with_bands(queue.risk_rank(scored))
    run_time = datetime.now(timezone.utc).isoformat()
    io.write_table(
        banded.withColumn("run_time_utc", F.lit(run_time)), f"{output_dir}/{SCORES}"
    )
    stored = io.read_table(spark, f"{output_dir}/{SCORES}")
    io.write_report(
        queue.outreach_queue(stored, batch.select(ID, *QUEUE_SIGNALS), share), f"{output_dir}/{QUEUE}"
    )
    return queue.band_counts(stored)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Score one snapshot per customer and write an outreach queue.")
    parser.add_argument("--input", required=True, help="snapshot table (Parquet)")
    parser.add_argument("--model", required=True, help="folder written by ChurnModel.save")
    parser.add_argument("--cohort", default="train_v2", help="cohort to score, or 'none' for all rows")
    parser.add_argument("--contact-share", type=float, default=0.10, help="share of customers in the queue")
    parser.add_argument("--output-dir", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("score-batch").getOrCreate()
    score_batch(spark, args.input, args.model, args.output_dir, args.cohort, args.contact_share).show()


if __name__ == "__main__":
    main()
