"""Data-quality tables over the built tables, each a single aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import is_finite
from ebbtide.spec import (
    BAND_CUTS,
    BAND_REST,
    CATEGORICAL_FEATURES,
    EXTREME_SECONDS,
    ID,
    LABEL,
    LOG_SECONDS,
    NUMERIC_FEATURES,
)


def _seconds_checks(column: str) -> list[Column]:
    value = F.col(column)
    return [
        F.min(value).alias("min_monthly_secs"),
        F.max(value).alias("max_monthly_secs"),
        F.sum(value).alias("total_secs_sum"),
        F.count_if(value.isNotNull() & ~is_finite(value)).alias("non_finite_rows"),
        F.count_if(value < 0).alias("negative_rows"),
    ]


def usage_diagnostics(usage: DataFrame, column: str = LOG_SECONDS, extreme: float = EXTREME_SECONDS) -> DataFrame:
    return usage.agg(
        *_seconds_checks(column), F.count_if(F.abs(column) > extreme).alias("extreme_rows")
    )


def usage_diagnostics_by_month(usage: DataFrame, column: str = LOG_SECONDS, period: str = "month") -> DataFrame:
    return usage.groupBy(period).agg(*_seconds_checks(column)).orderBy(period)


def clean_seconds_summary(usage: DataFrame) -> DataFrame:
    return usage.agg(
        F.min("total_secs_clean").alias("minimum_monthly_seconds"),
        F.max("total_secs_clean").alias("maximum_monthly_seconds"),
        F.sum("total_secs_clean").alias("total_clean_seconds"),
        F.sum("invalid_secs_rows").alias("invalid_daily_rows"),
        F.sum("capped_secs_rows").alias("capped_daily_rows"),
    )


def monthly_tx_summary(tx: DataFrame, id_col: str = ID) -> DataFrame:
    return tx.agg(
        F.count("*").alias("customer_month_rows"),
        F.count_distinct(id_col).alias("customers"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )


def anchor_coverage(anchors: DataFrame) -> DataFrame:
    return (
        anchors.groupBy("cohort")
        .agg(
            F.count("*").alias("customers"),
            F.count("anchor_expiry_date").alias("customers_with_anchor"),
            F.count_if(F.col("anchor_expiry_date").isNull()).alias("customers_without_anchor"),
        )
        .orderBy("cohort")
    )


def snapshot_churn_summary(snapshot: DataFrame, label_col: str = LABEL) -> DataFrame:
    return (
        snapshot.groupBy("cohort")
        .agg(
            F.count("*").alias("customers"),
            F.sum(label_col).alias("churned_customers"),
            F.avg(label_col).alias("churn_rate"),
        )
        .orderBy("cohort")
    )


def snapshot_cohort_checks(snapshot: DataFrame, id_col: str = ID, label_col: str = LABEL) -> DataFrame:
    anchor = F.col("anchor_expiry_date")
    return (
        snapshot.groupBy("cohort")
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct(id_col).alias("unique_customers"),
            F.count_if(F.col(label_col).isNull()).alias("missing_labels"),
            F.count_if(anchor.isNull()).alias("missing_anchors"),
            F.count_if(F.substring(anchor, 1, 6) != F.col("target_expiry_month")).alias(
                "anchor_month_mismatches"
            ),
            F.min(label_col).alias("min_label"),
            F.max(label_col).alias("max_label"),
            F.avg(label_col).alias("churn_rate"),
        )
        .orderBy("cohort")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key groups that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicate_groups"))
    )


def feature_ranges(snapshot: DataFrame) -> DataFrame:
    def span(column: str, name: str) -> list[Column]:
        return [F.min(column).alias(f"min_{name}"), F.max(column).alias(f"max_{name}")]

    return snapshot.agg(
        *span("age", "age"),
        *span("tenure_months_at_cutoff", "tenure_months"),
        *span("listening_secs_last3", "listening_secs_last3"),
        *span("paid_amount_last3", "paid_amount_last3"),
        F.count_if(F.col("tenure_months_at_cutoff") < 0).alias("negative_tenure_rows"),
        F.count_if(F.col("listening_secs_last3") < 0).alias("negative_listening_rows"),
        F.count_if(F.col("paid_amount_last3") < 0).alias("negative_payment_rows"),
    )


def feature_missingness(snapshot: DataFrame) -> DataFrame:
    gender = F.col("gender")
    return (
        snapshot.groupBy("cohort")
        .agg(
            F.count_if(F.col("age").isNull()).alias("age_missing"),
            F.count_if(F.col("city").isNull()).alias("city_missing"),
            F.count_if(gender.isNull() | (gender == "")).alias("gender_missing"),
            F.count_if(F.col("weighted_avg_plan_days_last3").isNull()).alias("plan_days_missing"),
        )
        .orderBy("cohort")
    )


def scored_checks(scored: DataFrame, id_col: str = ID, score: str = "risk_score") -> DataFrame:
    return scored.agg(
        F.count("*").alias("scored_customers"),
        F.count_distinct(id_col).alias("unique_customers"),
        F.count_if(F.col(score).isNull()).alias("missing_scores"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )


def band_position(band: Column, cuts: Sequence[tuple[str, int]] = BAND_CUTS) -> Column:
    """1 for the riskiest band, counting up; the rest band comes last."""
    place = F.lit(len(cuts) + 1)
    for i, (name, _) in reversed(list(enumerate(cuts, start=1))):
        place = F.when(band == name, i).otherwise(place)
    return place


def churn_by_band(
    scored: DataFrame, snapshot: DataFrame, cohort: str, id_col: str = ID, label_col: str = LABEL
) -> DataFrame:
    """Observed churn of one cohort per risk band, riskiest first."""
    observed = snapshot.where(F.col("cohort") == cohort).select(id_col, label_col)
    return (
        scored.select(id_col, "risk_band")
        .join(observed, id_col)
        .groupBy("risk_band")
        .agg(F.count("*").alias("customers"), F.avg(label_col).alias("observed_churn_rate"))
        .orderBy(band_position(F.col("risk_band")))
    )


def queue_checks(queue: DataFrame, label_col: str = LABEL) -> DataFrame:
    """Header, whether the label slipped in, and row count of an outreach file."""
    return queue.agg(F.count("*").alias("queue_rows")).select(
        F.lit(",".join(queue.columns)).alias("header_columns"),
        F.lit(label_col in queue.columns).alias("has_label"),
        "queue_rows",
    )


SCORING_COLUMNS = (ID, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES)


def missing_columns(df: DataFrame, required: Sequence[str] = SCORING_COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def batch_contract(
    df: DataFrame, required: Sequence[str] = SCORING_COLUMNS, id_col: str = ID, score: str = "risk_score"
) -> DataFrame:
    """Violations of the scoring contract as rows ``(violation, detail)``; none if the batch is fine.

    A batch that has the score column already must have a number there in every row.

    The schema is compared first; data is read only if the id column exists.
    """
    spark = df.sparkSession
    absent = missing_columns(df, required)
    listed = spark.createDataFrame(
        [("missing columns", ", ".join(absent))] if absent else [], "violation string, detail string"
    )
    if id_col not in df.columns:
        return listed
    unscored = F.count_if(F.col(score).isNull() | F.isnan(score)) if score in df.columns else F.lit(0).cast("bigint")
    per_id = df.groupBy(id_col).agg(F.count("*").alias("_n"), unscored.alias("_u"))
    counted = per_id.agg(
        F.count("*").alias("_ids"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.count_if(F.col("_n") > 1).alias("_repeated"),
        F.coalesce(F.sum("_u"), F.lit(0)).alias("_unscored"),
    )
    findings = counted.select(
        F.inline(
            F.filter(
                F.array(
                    F.struct(
                        F.when(F.col("_rows") == 0, "no rows").alias("violation"),
                        F.lit("0").alias("detail"),
                    ),
                    F.struct(
                        F.when(F.col("_repeated") > 0, "duplicate ids").alias("violation"),
                        F.col("_repeated").cast("string").alias("detail"),
                    ),
                    F.struct(
                        F.when(F.col("_unscored") > 0, "missing scores").alias("violation"),
                        F.col("_unscored").cast("string").alias("detail"),
                    ),
                ),
                lambda v: v["violation"].isNotNull(),
            )
        )
    )
    return listed.unionByName(findings)


def enforce_contract(df: DataFrame, required: Sequence[str] = SCORING_COLUMNS, id_col: str = ID) -> DataFrame:
    """The required columns of ``df``; raises if the batch breaks the contract."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"input lacks required columns: {absent}")
    broken = batch_contract(df, required, id_col).collect()
    if broken:
        raise ValueError("; ".join(f"{r.violation}: {r.detail}" for r in broken))
    return df.select(*required)
