"""Training and evaluation job: both models, their metrics, lift, curves, calibration and importance.

    spark-submit -m ebbtide.plans.train --snapshot tables/snapshot_features --output-dir models/
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import metrics, models, prepare, queue, signals
from ebbtide.session import durable
from ebbtide.sources import io
from ebbtide.spec import DEFAULT_COHORTS, ID, LABEL, REVIEW_ACTIONS

# Fixed values of the reports.
LINEAR, BOOSTED = "Logistic baseline", "Boosted trees"
VALIDATION, LATER = "Internal validation", "Later cohort"


def train_and_evaluate(
    spark: SparkSession,
    snapshot_path: str,
    output_dir: str,
    early: str = DEFAULT_COHORTS[0].name,
    late: str = DEFAULT_COHORTS[1].name,
    share: float = 0.10,
    max_iter: int = 150,
    repeats: int = 5,
) -> DataFrame:
    """Fit on 80 % of the early cohort, evaluate on the rest and on the late cohort.

    Writes the models, ``model_metrics``, ``lift``, ``pr_curve``,
    ``top_group``, ``calibration_metrics``, the calibration bins,
    ``permutation_importance``, ``signal_rates``, the labelled scores and the
    top-decile queue. Returns the model metrics.
    """
    snapshot = io.read_table(spark, snapshot_path)
    split = durable(prepare.stratified_split(snapshot.where(F.col("cohort") == early)))
    train, validation = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    later = snapshot.where(F.col("cohort") == late)

    fitted = {
        LINEAR: models.fit_linear(train),
        BOOSTED: models.fit_boosted(
            train, max_iter=max_iter, schema=prepare.category_schema(snapshot.where(F.col("cohort") == early))
        ),
    }
    parts = []
    for name, model in fitted.items():
        model.save(f"{output_dir}/{name.lower().replace(' ', '_')}")
        for period, rows in ((VALIDATION, validation), (LATER, later)):
            scored = model.score(rows).select(ID, LABEL, "risk_score")
            parts.append(scored.select(F.lit(name).alias("model"), F.lit(period).alias("period"), "*"))
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    io.write_table(stacked, f"{output_dir}/scores", partition_by=["model", "period"])
    scores = io.read_table(spark, f"{output_dir}/scores")

    def report(df: DataFrame, name: str) -> None:
        io.write_report(df, f"{output_dir}/{name}", forbid=(), single_file=True)

    by = ["model", "period"]
    thresholds = metrics.topk_threshold(
        scores.where(F.col("period") == VALIDATION), share, by=["model"]
    )
    overall = durable(metrics.model_metrics(scores, thresholds))
    lift = durable(metrics.lift_table(scores, by=by))
    report(overall, "model_metrics")
    report(lift, "lift")
    report(metrics.cumulative_gains(lift, by), "gains")
    report(metrics.top_group_comparison(lift), "top_group")
    io.write_table(metrics.pr_curve(scores, by=by), f"{output_dir}/pr_curve")

    def boosted(period: str) -> DataFrame:
        return scores.where((F.col("model") == BOOSTED) & (F.col("period") == period)).select(
            ID, LABEL, "risk_score"
        )

    isotonic = models.fit_isotonic(boosted(VALIDATION))
    isotonic.write().overwrite().save(f"{output_dir}/isotonic")
    calibrated = models.calibrate(isotonic, boosted(LATER))
    report(
        metrics.calibration_comparison(
            calibrated, {"Raw model score": "risk_score", "Isotonic calibrated": "calibrated_score"}
        ),
        "calibration_metrics",
    )
    report(metrics.calibration_bins(calibrated), "raw_score_calibration_bins")
    report(metrics.calibration_bins(calibrated, score="calibrated_score"), "calibrated_score_bins")

    report(
        models.permutation_importance(fitted[BOOSTED], validation, repeats=repeats), "permutation_importance"
    )
    report(signals.signal_rates(snapshot), "signal_rates")

    ranked = queue.with_bands(queue.risk_rank(boosted(LATER)))
    io.write_table(ranked, f"{output_dir}/later_cohort_scored_for_evaluation")
    stored = io.read_table(spark, f"{output_dir}/later_cohort_scored_for_evaluation")
    report(queue.band_summary(stored), "later_cohort_risk_band_summary")
    io.write_report(
        queue.top_decile_queue(stored, later, REVIEW_ACTIONS), f"{output_dir}/top_decile_outreach_queue"
    )
    return overall


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train and evaluate churn models on a snapshot table.")
    parser.add_argument("--snapshot", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--early", default=DEFAULT_COHORTS[0].name)
    parser.add_argument("--late", default=DEFAULT_COHORTS[1].name)
    parser.add_argument("--contact-share", type=float, default=0.10)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("train").getOrCreate()
    train_and_evaluate(
        spark, args.snapshot, args.output_dir, args.early, args.late, args.contact_share
    ).show()


if __name__ == "__main__":
    main()
