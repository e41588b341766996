"""From raw events to one row per customer and period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import day_text, is_finite, month_of, real, rounded_to, whole
from ebbtide.operators.profile import PERIOD_LENGTH
from ebbtide.spec import (
    ID,
    LABEL,
    LOG_COUNTERS,
    LOG_SECONDS,
    SECONDS_PER_DAY,
    TRANSACTION_COLUMNS,
    Cohort,
)


def cohort_labels(
    labels: Mapping[str, DataFrame], cohorts: Sequence[Cohort], id_col: str = ID, label_col: str = LABEL
) -> DataFrame:
    """Label tables stacked with their cohort name and target month."""
    parts = [
        labels[c.name].select(
            F.col(id_col),
            F.lit(c.name).alias("cohort"),
            F.lit(c.target).alias("target_expiry_month"),
            whole(F.col(label_col)).alias(label_col),
        )
        for c in cohorts
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stack_events(*tables: DataFrame, columns: Sequence[str] = TRANSACTION_COLUMNS) -> DataFrame:
    """Tables stacked by column name; a column that a table lacks is NULL there."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return stacked.select(*columns)


def dedupe_events(*tables: DataFrame, columns: Sequence[str] = TRANSACTION_COLUMNS) -> DataFrame:
    """Stack by column name and remove exact duplicates of the raw text.

    The distinct runs on all columns, so a customer with very many rows is spread
    over tasks; only true copies meet, and those are merged before the shuffle.
    """
    return stack_events(*tables, columns=columns).distinct()


def restrict_to(df: DataFrame, ids: DataFrame, on: str = ID) -> DataFrame:
    """Rows whose customer is among ``ids``.

    Apply it to a rolled-up table where possible: filtering commutes with the
    roll-up, and the shuffle then carries a few rows per customer instead of
    every event.
    """
    return df.join(ids.select(on).distinct(), on, "left_semi")


def log_period(date_col: str, grain: str) -> Column:
    return F.substring(F.col(date_col), 1, PERIOD_LENGTH[grain])


def _seconds(column: str) -> Column:
    value = real(F.col(column))
    return F.when(~F.isnan(value), value)


def _counter(column: str, bad_numbers: str) -> Column:
    if bad_numbers == "error":
        return F.col(column).cast("bigint")
    return rounded_to(F.col(column), "bigint")


def usage_sums(counters: Sequence[str], seconds: str, bad_numbers: str) -> list[Column]:
    return [
        *[F.sum(_counter(c, bad_numbers)).alias(c) for c in counters],
        F.coalesce(F.sum(_seconds(seconds)), F.lit(0.0)).alias(seconds),
        F.count("*").alias("log_rows"),
    ]


def clean_sums(seconds: str, cap: float) -> list[Column]:
    value = real(F.col(seconds))
    finite = is_finite(value)
    invalid = ~finite | (value < 0)
    capped = finite & (value > cap)
    clean = F.when(invalid, 0.0).when(capped, float(cap)).otherwise(value)
    return [
        F.sum(clean).alias(f"{seconds}_clean"),
        F.count_if(invalid).alias("invalid_secs_rows"),
        F.count_if(capped).alias("capped_secs_rows"),
    ]


def _by_period(logs: DataFrame, id_col: str, date_col: str, grain: str):
    period = "month" if grain == "month" else grain
    return (
        logs.withColumn(period, log_period(date_col, grain))
        .where(F.col(period).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(id_col, period)
    )


def monthly_usage(
    logs: DataFrame,
    id_col: str = ID,
    date_col: str = "date",
    counters: Sequence[str] = LOG_COUNTERS,
    seconds: str = LOG_SECONDS,
    grain: str = "month",
    bad_numbers: str = "null",
) -> DataFrame:
    """Counter and raw-seconds sums per customer and period.

    Rows without a date are left out and missing seconds are ignored, a period without
    any has 0; infinite seconds stay visible in the sum. ``bad_numbers="error"`` fails on counters
    that are not integers instead of skipping them.
    """
    return _by_period(logs, id_col, date_col, grain).agg(
        *usage_sums(counters, seconds, bad_numbers)
    )


def monthly_clean_seconds(
    logs: DataFrame,
    id_col: str = ID,
    date_col: str = "date",
    seconds: str = LOG_SECONDS,
    cap: float = SECONDS_PER_DAY,
    grain: str = "month",
) -> DataFrame:
    """Daily seconds with bad values as 0 and long days cut to ``cap``, summed per period."""
    return _by_period(logs, id_col, date_col, grain).agg(*clean_sums(seconds, cap))


def merge_clean_seconds(
    usage: DataFrame, clean: DataFrame, id_col: str = ID, seconds: str = LOG_SECONDS, period: str = "month"
) -> DataFrame:
    """Replace raw seconds by a separately built clean table; 0 where it has no row."""
    corrected = [f"{seconds}_clean", "invalid_secs_rows", "capped_secs_rows"]
    return usage.drop(seconds).join(clean, [id_col, period], "left").select(
        *[c for c in usage.columns if c != seconds],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in corrected],
    )


def monthly_clean_usage(
    logs: DataFrame,
    id_col: str = ID,
    date_col: str = "date",
    counters: Sequence[str] = LOG_COUNTERS,
    seconds: str = LOG_SECONDS,
    cap: float = SECONDS_PER_DAY,
    grain: str = "month",
    bad_numbers: str = "null",
    keep_raw: bool = False,
) -> DataFrame:
    """Usage with clean seconds in one scan and one shuffle.

    Equal to merging :func:`monthly_clean_seconds` into :func:`monthly_usage` of
    the same logs. ``keep_raw`` keeps the raw seconds next to the clean ones.
    """
    both = _by_period(logs, id_col, date_col, grain).agg(
        *usage_sums(counters, seconds, bad_numbers), *clean_sums(seconds, cap)
    )
    return both if keep_raw else both.drop(seconds)


def monthly_transactions(tx: DataFrame, id_col: str = ID) -> DataFrame:
    """Transaction summary per customer and month; rows without a real date are dropped."""
    dated = tx.withColumn("month", month_of(F.col("transaction_date")))
    return (
        dated.where(F.col("month").isNotNull())
        .groupBy(id_col, "month")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum(real(F.col("actual_amount_paid"))).alias("paid_amount_sum"),
            F.sum(real(F.col("plan_list_price"))).alias("list_price_sum"),
            F.avg(real(F.col("payment_plan_days"))).alias("avg_plan_days"),
            F.count_if(whole(F.col("is_auto_renew")) == 1).alias("auto_renew_count"),
            F.count_if(whole(F.col("is_cancel")) == 1).alias("cancel_count"),
            F.count_distinct("payment_method_id").alias("payment_method_count"),
        )
    )


def cohort_anchors(labels: DataFrame, tx: DataFrame, id_col: str = ID, label_col: str = LABEL) -> DataFrame:
    """Each label row with the latest expiry that falls in its target month, or NULL.

    Transactions shrink to the latest expiry per customer and month before the
    join, which then matches at most one row per label; ``tx`` need not be free of
    duplicates, which cannot change a maximum. The expiry is compared as a number:
    a maximum of text would make Spark sort every transaction.
    """
    expiry = day_text(F.col("membership_expire_date"))
    latest = (
        tx.select(id_col, F.substring(expiry, 1, 6).alias("target_expiry_month"), expiry.cast("int").alias("_expiry"))
        .where(F.col("target_expiry_month").isNotNull())
        .groupBy(id_col, "target_expiry_month")
        .agg(F.lpad(F.max("_expiry").cast("string"), 8, "0").alias("anchor_expiry_date"))
    )
    keys = [id_col, "cohort", "target_expiry_month", label_col]
    return labels.select(*keys).distinct().join(
        latest, [id_col, "target_expiry_month"], "left"
    ).select(*keys, "anchor_expiry_date")


def member_attributes(members: DataFrame, id_col: str = ID) -> DataFrame:
    """One row per member, taking the largest value of each attribute."""
    return members.groupBy(id_col).agg(
        F.max(whole(F.col("city"))).alias("city"),
        F.max(whole(F.col("bd"))).alias("bd"),
        F.max(F.col("gender")).alias("gender"),
        F.max(F.col("registered_via")).alias("registered_via"),
        F.max(F.col("registration_init_time")).alias("registration_init_time"),
    )
