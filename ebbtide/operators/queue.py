"""Risk ranks, bands, summaries and the capacity-limited outreach queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.scalars import known, ratio, share_of
from ebbtide.operators.rank import falling, group_number, ranked
from ebbtide.spec import (
    BAND_CUTS,
    BAND_REST,
    BATCH_ACTIONS,
    ID,
    LABEL,
    QUEUE_SIGNALS,
    ActionTexts,
)


def risk_rank(
    df: DataFrame, groups: int = 10, score: str = "risk_score", id_col: str = ID, by: Sequence[str] = ()
) -> DataFrame:
    """Rank by falling score, ties by id, and the equal-size group of that rank (1 is riskiest).

    Missing and not-a-number scores come last.
    """
    order = [falling(known(F.col(score))), F.col(id_col)]
    placed = ranked(df, order, by, rank="risk_rank", total="ranked_customers")
    return placed.withColumn(
        "risk_decile", group_number(F.col("risk_rank"), F.col("ranked_customers"), groups)
    )


def risk_band(
    decile: Column, cuts: Sequence[tuple[str, int]] = BAND_CUTS, rest: str = BAND_REST
) -> Column:
    band = F.lit(rest)
    for name, last in reversed(cuts):
        band = F.when(decile <= last, name).otherwise(band)
    return band


def with_bands(df: DataFrame, cuts: Sequence[tuple[str, int]] = BAND_CUTS) -> DataFrame:
    return df.withColumn("risk_band", risk_band(F.col("risk_decile"), cuts))


def band_summary(scored: DataFrame, label: str = LABEL, score: str = "risk_score") -> DataFrame:
    """Observed churn, mean score and lift per decile and band."""
    overall = scored.agg(F.avg(label)).scalar()
    return (
        scored.groupBy("risk_decile", "risk_band")
        .agg(
            F.count("*").alias("customers"),
            F.sum(label).cast("bigint").alias("churners"),
            F.avg(label).alias("observed_churn_rate"),
            F.avg(score).alias("mean_risk_score"),
        )
        .withColumn("lift_vs_overall", ratio(F.col("observed_churn_rate"), overall))
        .orderBy("risk_decile")
    )


def band_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_band").agg(F.count("*").alias("customers"))


def suggested_action(texts: ActionTexts = BATCH_ACTIONS) -> Column:
    """The first rule that applies; a missing signal never triggers a rule."""
    renewal = (
        (F.col("auto_renew_count_last3") == 0)
        | (F.col("transactions_last_month") == 0)
        | (F.col("paid_amount_last3") == 0)
    )
    return (
        F.when(F.col("cancel_count_last3") > 0, texts.cancellation)
        .when(renewal, texts.renewal)
        .when(F.col("listening_secs_last3") == 0, texts.adoption)
        .otherwise(texts.personal)
    )


QUEUE_COLUMNS = (ID, "risk_score", "risk_decile", "risk_band", *QUEUE_SIGNALS, "suggested_action")


def _queue(chosen: DataFrame, features: DataFrame, texts: ActionTexts, id_col: str) -> DataFrame:
    signals = features.select(id_col, *QUEUE_SIGNALS)
    return (
        chosen.join(signals, id_col)
        .withColumn("suggested_action", suggested_action(texts))
        .orderBy("risk_rank")
        .select(id_col, *QUEUE_COLUMNS[1:])
    )


def check_share(share: float) -> float:
    if not 0 < share <= 1:
        raise ValueError("the contact share must be greater than 0 and at most 1")
    return float(share)


def outreach_queue(
    scored: DataFrame,
    features: DataFrame,
    share: float = 0.10,
    texts: ActionTexts = BATCH_ACTIONS,
    id_col: str = ID,
) -> DataFrame:
    """The riskiest ``max(1, ceil(share * n))`` customers with their signals and next step.

    ``scored`` comes from :func:`risk_rank`; it is cut down before the features are joined.
    """
    wanted = share_of(F.col("ranked_customers"), check_share(share))
    return _queue(scored.where(F.col("risk_rank") <= wanted), features, texts, id_col)


def top_decile_queue(
    scored: DataFrame, features: DataFrame, texts: ActionTexts = BATCH_ACTIONS, id_col: str = ID
) -> DataFrame:
    return _queue(scored.where(F.col("risk_decile") == 1), features, texts, id_col)


def scored_for_evaluation(
    scored: DataFrame, labels: DataFrame, id_col: str = ID, label: str = LABEL
) -> DataFrame:
    """Scores with their labels, to be stored apart from the queue."""
    return scored.join(labels.select(id_col, label), id_col).select(
        id_col, label, "risk_score", "risk_decile", "risk_band"
    )
