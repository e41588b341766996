"""Exact evaluation of scores against 0/1 labels; no score ever leaves the executors.

Every function takes ``by``, a list of low-cardinality columns such as model and
period, and returns one result per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.scalars import known, ratio, share_of
from ebbtide.operators.lookup import attach
from ebbtide.operators.rank import exact_quantiles, falling, group_number, ranked, totals_by_value
from ebbtide.spec import ID, LABEL, SCORE_EPSILON


def score_counts(
    df: DataFrame, label: str = LABEL, score: str = "risk_score", by: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score with totals from the top score down.

    Missing and not-a-number scores are one value that comes last.
    """
    sums = {name: F.coalesce((F.col(label) == value).cast("bigint"), F.lit(0)) for name, value in (("pos", 1), ("neg", 0))}
    return totals_by_value(df, known(F.col(score)), "score", sums, by, descending=True)


def _flagged() -> Column:
    return F.col("cum_pos") + F.col("cum_neg")


def ap_of_counts() -> Column:
    # Decimal, so that the sum does not depend on its order.
    gain = (F.col("pos").cast("double") * ratio(F.col("cum_pos"), _flagged())).cast("decimal(38,18)")
    return F.try_divide(F.sum(gain).cast("double"), F.max("total_pos").cast("double"))


def auc_of_counts() -> Column:
    wide = "decimal(19,0)"
    below = F.col("total_neg") - F.col("cum_neg")
    twice = F.sum(F.col("pos").cast(wide) * (below * 2 + F.col("neg")).cast(wide))
    pairs = F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    return F.try_divide(twice.cast("double"), pairs * 2)


def average_precision(df: DataFrame, label: str = LABEL, score: str = "risk_score", by: Sequence[str] = ()) -> DataFrame:
    """Step-wise sum of recall gain times precision over distinct scores; NULL without positives."""
    return score_counts(df, label, score, by).groupBy(*by).agg(ap_of_counts().alias("average_precision"))


def roc_auc(df: DataFrame, label: str = LABEL, score: str = "risk_score", by: Sequence[str] = ()) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; NULL with a single class."""
    return score_counts(df, label, score, by).groupBy(*by).agg(auc_of_counts().alias("roc_auc"))


def pr_curve(df: DataFrame, label: str = LABEL, score: str = "risk_score", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score, plus the end point without a threshold.

    Rows without a score count in the totals, but no threshold reaches them, so they are no point of the curve.
    """
    counts = score_counts(df, label, score, by)
    points = counts.where(F.col("score").isNotNull()).select(
        *by,
        ratio(F.col("cum_pos"), _flagged()).alias("precision"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = counts.groupBy(*by).agg(
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
    )
    return points.unionByName(end)


def topk_threshold(
    df: DataFrame, share: float = 0.10, score: str = "risk_score", by: Sequence[str] = ()
) -> DataFrame:
    """Score of the k-th highest row, with ``k = max(1, ceil(share * n))``."""
    totals = totals_by_value(df, known(F.col(score)), "threshold", {"n": F.lit(1)}, by, descending=True)
    k = share_of(F.col("total_n"), share)
    return totals.where((F.col("cum_n") - F.col("n") < k) & (k <= F.col("cum_n"))).select(
        *by, F.col("total_n").alias("customers"), k.alias("k"), "threshold"
    )


def threshold_metrics_of(label: Column, score: Column, threshold: Column) -> dict[str, Column]:
    """Aggregates describing the rows with a score at or above the threshold; 0 where undefined."""
    flagged = known(score) >= threshold
    n, positives = F.count("*"), F.count_if(label == 1)
    hit, called = F.count_if(flagged & (label == 1)), F.count_if(flagged)
    zero = F.lit(0.0)
    return {
        "threshold": F.max(threshold),
        "customers_flagged": called,
        "flagged_share": ratio(called, n),
        "precision": F.coalesce(ratio(hit, called), zero),
        "recall": F.coalesce(ratio(hit, positives), zero),
        "lift_at_threshold": F.coalesce(
            F.try_divide(ratio(hit, called), ratio(positives, n)), zero
        ),
    }


def threshold_metrics(
    df: DataFrame, threshold: Column | float, label: str = LABEL, score: str = "risk_score", by: Sequence[str] = ()
) -> DataFrame:
    """Flagged rows, precision, recall and lift at a threshold; tied rows are flagged together."""
    at = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    columns = threshold_metrics_of(F.col(label), F.col(score), F.col("_at"))
    return df.withColumn("_at", at).groupBy(*by).agg(*[c.alias(n) for n, c in columns.items()])


def lift_table(
    df: DataFrame,
    groups: int = 10,
    label: str = LABEL,
    score: str = "risk_score",
    id_col: str = ID,
    by: Sequence[str] = (),
) -> DataFrame:
    """Churn, lift and cumulative recall per equal-size score group, best group first."""
    order = [falling(known(F.col(score))), F.col(id_col)]
    placed = ranked(df.select(*by, id_col, score, label), order, by)
    per_group = placed.groupBy(
        *by, group_number(F.col("rank"), F.col("total"), groups).alias("group")
    ).agg(
        F.count("*").alias("customers"),
        F.sum(label).cast("bigint").alias("churners"),
        F.avg(label).alias("churn_rate"),
    )
    everything = Window.partitionBy(*by)
    so_far = everything.orderBy("group").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total, churners = F.sum("customers").over(everything), F.sum("churners").over(everything)
    return per_group.select(
        *by,
        "group",
        "customers",
        "churners",
        "churn_rate",
        F.try_divide(F.col("churn_rate"), ratio(churners, total)).alias("lift"),
        F.sum("customers").over(so_far).alias("cumulative_customers"),
        F.sum("churners").over(so_far).alias("cumulative_churners"),
        ratio(F.sum("churners").over(so_far), churners).alias("cumulative_churn_recall"),
    ).orderBy(*by, "group")


def cumulative_gains(lift: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of customers contacted against share of churners reached, from a lift table."""
    everything = Window.partitionBy(*by)
    return lift.select(
        *by,
        "group",
        ratio(F.col("cumulative_customers"), F.sum("customers").over(everything)).alias("customer_share"),
        F.col("cumulative_churn_recall").alias("churner_share"),
    )


def clipped(score: Column, epsilon: float = SCORE_EPSILON) -> Column:
    return F.greatest(F.least(score.cast("double"), F.lit(1.0 - epsilon)), F.lit(epsilon))


def _brier(label: Column, score: Column) -> Column:
    return F.avg((score - label) * (score - label))


def _log_loss(label: Column, score: Column, epsilon: float) -> Column:
    p = clipped(score, epsilon)
    return F.avg(F.when(label == 1, -F.log(p)).otherwise(-F.log(1 - p)))


def brier_score(df: DataFrame, label: str = LABEL, score: str = "risk_score", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(_brier(F.col(label), F.col(score)).alias("brier_score"))


def log_loss(
    df: DataFrame, label: str = LABEL, score: str = "risk_score", epsilon: float = SCORE_EPSILON, by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by).agg(_log_loss(F.col(label), F.col(score), epsilon).alias("log_loss"))


def calibration_bins(
    df: DataFrame, q: int = 10, label: str = LABEL, score: str = "risk_score"
) -> DataFrame:
    """Mean score and observed rate per quantile bin.

    Edges are exact interpolated quantiles with repeats dropped; bins include
    their upper edge, and the first one its lower edge too. Only the ``q + 1``
    edges are read back as a scalar.
    """
    edges = (
        exact_quantiles(df, [score], [i / q for i in range(q + 1)])
        .agg(F.array_sort(F.collect_set("value")).alias("edges"))
        .scalar()
    )
    value = F.col(score).cast("double")
    bin_no = F.greatest(F.lit(1), F.size(F.filter("_edges", lambda e: e < value)))
    return (
        df.where(value.isNotNull() & ~F.isnan(value))
        .withColumn("_edges", edges)
        .groupBy(bin_no.alias("bin"))
        .agg(
            F.count("*").alias("customers"),
            F.avg(value).alias("mean_score"),
            F.avg(label).alias("observed_churn_rate"),
        )
        .orderBy("bin")
    )


def calibration_comparison(
    df: DataFrame, scores: Mapping[str, str], label: str = LABEL, epsilon: float = SCORE_EPSILON
) -> DataFrame:
    """Brier score and log loss of several score columns of the same rows, in one scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("score_type"), F.col(c).cast("double").alias("_score"))
            for name, c in scores.items()
        ]
    )
    return (
        df.select(label, F.inline(pairs))
        .groupBy("score_type")
        .agg(
            _brier(F.col(label), F.col("_score")).alias("brier_score"),
            _log_loss(F.col(label), F.col("_score"), epsilon).alias("log_loss"),
        )
    )


def model_metrics(
    df: DataFrame,
    thresholds: DataFrame,
    label: str = LABEL,
    score: str = "risk_score",
    by: Sequence[str] = ("model", "period"),
    threshold_by: Sequence[str] = ("model",),
) -> DataFrame:
    """Size, churn rate, AP, AUC and threshold metrics per model and period.

    ``thresholds`` has one ``threshold`` per ``threshold_by`` group, chosen on
    validation data. All numbers come from the running totals over distinct
    scores, so the rows are grouped once.
    """
    counts = attach(
        score_counts(df, label, score, by),
        thresholds.select(*threshold_by, "threshold"),
        list(threshold_by),
    )
    called = F.col("score") >= F.col("threshold")
    rows = F.col("pos") + F.col("neg")
    sums = counts.groupBy(*by).agg(
        F.sum(rows).alias("customers"),
        F.sum("pos").alias("_pos"),
        ap_of_counts().alias("average_precision"),
        auc_of_counts().alias("roc_auc"),
        F.max("threshold").alias("threshold"),
        F.coalesce(F.sum(F.when(called, rows)), F.lit(0)).alias("customers_flagged"),
        F.coalesce(F.sum(F.when(called, F.col("pos"))), F.lit(0)).alias("_hit"),
    )
    n, pos, flagged, hit = (F.col(c) for c in ("customers", "_pos", "customers_flagged", "_hit"))
    zero = F.lit(0.0)
    return sums.select(
        *by,
        "customers",
        ratio(pos, n).alias("churn_rate"),
        "average_precision",
        "roc_auc",
        "threshold",
        "customers_flagged",
        ratio(flagged, n).alias("flagged_share"),
        F.coalesce(ratio(hit, flagged), zero).alias("precision"),
        F.coalesce(ratio(hit, pos), zero).alias("recall"),
        F.coalesce(F.try_divide(ratio(hit, flagged), ratio(pos, n)), zero).alias("lift_at_threshold"),
    )


def top_group_comparison(lift: DataFrame, by: Sequence[str] = ("model", "period")) -> DataFrame:
    """The best score group of each model and period."""
    return lift.where(F.col("group") == 1).select(
        *by,
        F.col("customers").alias("customers_in_top_decile"),
        F.col("churn_rate").alias("observed_churn_rate"),
        "lift",
        F.col("cumulative_churn_recall").alias("share_of_all_churners_captured"),
    )
