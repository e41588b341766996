"""One registered query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbtide.catalog import adapters as A
from ebbtide.functions.scalars import real
from ebbtide.operators import (
    checks,
    experiment,
    integrity,
    metrics,
    models,
    monitoring,
    prepare,
    profile,
    queue,
    rank,
    rollup,
    signals,
    snapshot as snap,
)
from ebbtide.operators.incremental import UsageStore
from ebbtide.plans import score_batch as scoring
from ebbtide.session import durable, scratch_path
from ebbtide.sources import io
from ebbtide.spec import (
    CATEGORICAL_FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    REVIEW_ACTIONS,
    BAND_CUTS_WIDE,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
CATEGORIES = list(CATEGORICAL_FEATURES)
ROUNDED = {
    "listening_secs_last3": 2,
    "listening_secs_prev3": 2,
    "listening_secs_last6": 2,
    "paid_amount_last3": 2,
    "weighted_avg_plan_days_last3": 6,
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Fix the digits of sums and ratios, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


# --- shared inputs ---------------------------------------------------------


def ids(spark, d):
    return profile.cohort_ids(A.labels(spark, d))


def usage(spark, d):
    return rollup.restrict_to(rollup.monthly_clean_usage(A.all_logs(spark, d)), ids(spark, d))


def raw_usage(spark, d):
    return rollup.restrict_to(rollup.monthly_usage(A.all_logs(spark, d)), ids(spark, d))


def tx_monthly(spark, d):
    return rollup.restrict_to(
        rollup.monthly_transactions(A.distinct_transactions(spark, d)), ids(spark, d)
    )


def anchors(spark, d):
    return rollup.cohort_anchors(A.cohort_labels(spark, d), A.stacked_transactions(spark, d))


def snapshot(spark, d):
    """The anchors pick their customers from the roll-ups, so these are not restricted first."""
    return snap.build_snapshot(
        anchors(spark, d),
        rollup.monthly_clean_usage(A.all_logs(spark, d)),
        rollup.monthly_transactions(A.distinct_transactions(spark, d)),
        A.members(spark, d),
        before=max(c.target for c in A.COHORTS),
    )


def cohort(df, name):
    return df.where(F.col("cohort") == name)


def late_scores(spark, d):
    return cohort(A.planted_scores(spark, d), "late").drop("cohort")


def late_deciles(spark, d):
    return queue.with_bands(queue.risk_rank(late_scores(spark, d)))


# --- sources and sinks -----------------------------------------------------


@query
def sink_parquet_zstd(spark, d):
    path = scratch_path(spark, "monthly-transactions")
    io.write_table(tx_monthly(spark, d), path, partition_by=["month"])
    back = io.read_table(spark, path).withColumn("month", F.col("month").cast("string"))
    return rounded(back, {"paid_amount_sum": 2, "list_price_sum": 2, "avg_plan_days": 6})


@query
def sink_queue_without_label(spark, d):
    path = scratch_path(spark, "outreach-queue")
    io.write_report(late_deciles(spark, d), path)
    columns = ["msno", "risk_score", "risk_rank", "ranked_customers", "risk_decile", "risk_band"]
    back = io.read_raw(spark, path)
    assert back.columns == columns
    return back.select(
        "msno",
        F.round(real(F.col("risk_score")), 6).alias("risk_score"),
        *[F.col(c).cast("bigint").alias(c) for c in columns[2:5]],
        "risk_band",
    )


@query
def source_inventory(spark, d):
    found = io.source_inventory(spark, {t: f"{d}/{t}.parquet" for t in TABLES}, fmt="parquet")
    return found.select("source", "columns", "rows", F.size("first_rows").alias("shown"))


@query
def source_rows(spark, d):
    return io.source_rows({t: A.table(spark, d, t) for t in TABLES})


# --- profiling -------------------------------------------------------------


@query
def date_coverage(spark, d):
    return profile.date_coverage(rollup.stack_events(*A.transactions(spark, d).values()), "transaction_date")


@query
def rows_by_month(spark, d):
    return profile.rows_by_period(rollup.stack_events(*A.transactions(spark, d).values()), "transaction_date")


@query
def events_rows_by_day(spark, d):
    day = A.table(spark, d, "events").select(F.date_format("ts", "yyyyMMdd").alias("date"))
    return profile.rows_by_period(day, "date", grain="day")


@query
def date_range_by_source(spark, d):
    return profile.date_range_by_source(
        A.transactions(spark, d), ["transaction_date", "membership_expire_date"]
    )


@query
def expiry_match(spark, d):
    return profile.expiry_match(A.transactions(spark, d), A.labels(spark, d), A.COHORTS)


@query
def value_anomalies(spark, d):
    return profile.value_anomalies(A.logs(spark, d), "total_secs", ids(spark, d))


@query
def anomaly_examples(spark, d):
    found = profile.anomaly_examples(A.logs(spark, d), "total_secs", ids(spark, d))
    value = F.col("total_secs").cast("double")
    shown = F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").otherwise(F.round(value, 2).cast("decimal(18,2)").cast("string"))
    return found.select("source", "msno", "date", "example", shown.alias("total_secs"))


@query
def unreadable_values(spark, d):
    return profile.unreadable_values(
        rollup.stack_events(*A.transactions(spark, d).values()), ["payment_plan_days", "payment_method_id", "is_cancel"]
    )


@query
def cohort_ids(spark, d):
    return ids(spark, d)


@query
def cohort_sizes(spark, d):
    return profile.cohort_sizes(A.labels(spark, d))


# --- roll-ups --------------------------------------------------------------


@query
def cohort_labels(spark, d):
    return rollup.cohort_labels(A.labels(spark, d), A.COHORTS)


@query
def dedupe_transactions(spark, d):
    return A.distinct_transactions(spark, d)


@query
def restrict_to_cohort(spark, d):
    return rollup.restrict_to(A.distinct_transactions(spark, d), ids(spark, d))


@query
def monthly_usage(spark, d):
    return rounded(rollup.monthly_usage(A.all_logs(spark, d)), {"total_secs": 2})


@query
def monthly_clean_seconds(spark, d):
    return rounded(rollup.monthly_clean_seconds(A.all_logs(spark, d)), {"total_secs_clean": 2})


@query
def merge_clean_seconds(spark, d):
    """The second log file is corrected only: customer-months without a correction get 0."""
    merged = rollup.merge_clean_seconds(
        rollup.monthly_usage(A.all_logs(spark, d)),
        rollup.monthly_clean_seconds(A.logs(spark, d)["v2"]),
    )
    return rounded(merged, {"total_secs_clean": 2})


@query
def monthly_clean_usage(spark, d):
    return rounded(usage(spark, d), {"total_secs_clean": 2})


@query
def incremental_usage(spark, d):
    """The two log files as CSV, added one after the other, the first of them twice."""
    folder = scratch_path(spark, "usage-store")
    parts = A.logs(spark, d)
    for name, logs in parts.items():
        logs.write.option("header", True).csv(f"{folder}/{name}")
    store = UsageStore(spark, f"{folder}/store")
    store.add([f"{folder}/v1"])
    grown = store.add([f"{folder}/v1", f"{folder}/v2"])
    return rounded(rollup.restrict_to(grown.drop("total_secs"), ids(spark, d)), {"total_secs_clean": 2})


@query
def available_sources(spark, d):
    """Which of the tables of a list are there, and their rows; one of the list is not."""
    paths = {name: f"{d}/{name}.parquet" for name in ("customer", "lineitem", "orders", "refunds")}
    present, absent = io.available(spark, paths, missing="skip")
    tables = [io.read_table(spark, p).select(F.lit(n).alias("source"), F.lit(True).alias("present")) for n, p in present.items()]
    counted = reduce(lambda a, b: a.unionByName(b), tables).groupBy("source", "present").agg(F.count("*").alias("rows"))
    return counted.unionByName(spark.createDataFrame([(n, False, 0) for n in absent], "source string, present boolean, rows long"))


@query
def events_daily_usage(spark, d):
    events = A.table(spark, d, "events").select(
        A.customer_id("user_id"),
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("clicks"),
        F.col("value").alias("total_secs"),
    )
    out = rollup.monthly_clean_usage(events, counters=["clicks"], cap=50.0, grain="day")
    return rounded(out, {"total_secs_clean": 2})


@query
def monthly_transactions(spark, d):
    return rounded(
        tx_monthly(spark, d), {"paid_amount_sum": 2, "list_price_sum": 2, "avg_plan_days": 6}
    )


@query
def cohort_anchors(spark, d):
    return anchors(spark, d)


@query
def member_attributes(spark, d):
    return rollup.member_attributes(A.members(spark, d))


# --- snapshots -------------------------------------------------------------


@query
def usage_features(spark, d):
    return rounded(snap.usage_features(anchors(spark, d), usage(spark, d)), ROUNDED)


@query
def transaction_features(spark, d):
    return rounded(snap.transaction_features(anchors(spark, d), tx_monthly(spark, d)), ROUNDED)


@query
def clean_age(spark, d):
    attributes = rollup.member_attributes(A.members(spark, d))
    return attributes.select("msno", snap.clean_age(F.col("bd")).alias("age"))


@query
def tenure_months(spark, d):
    attributes = rollup.member_attributes(A.members(spark, d))
    tenure = snap.tenure_months(F.col("registration_init_time"), F.lit(A.COHORTS[0].target))
    return attributes.select("msno", tenure.alias("tenure_months_at_cutoff"))


@query
def snapshot_features(spark, d):
    return rounded(snapshot(spark, d), ROUNDED)


@query
def multi_cutoff_snapshot(spark, d):
    population = A.table(spark, d, "customer").select(A.customer_id("c_custkey"))
    out = snap.multi_cutoff_snapshot(
        population,
        A.MORE_CUTOFFS,
        rollup.monthly_clean_usage(A.all_logs(spark, d)),
        A.stacked_transactions(spark, d),
        rollup.monthly_transactions(A.distinct_transactions(spark, d)),
        A.members(spark, d),
    )
    return rounded(out.drop(LABEL), ROUNDED)


# --- checks and signals ----------------------------------------------------


@query
def usage_diagnostics(spark, d):
    return rounded(
        checks.usage_diagnostics(raw_usage(spark, d)),
        {"min_monthly_secs": 2, "max_monthly_secs": 2, "total_secs_sum": 2},
    )


@query
def usage_diagnostics_by_month(spark, d):
    return rounded(
        checks.usage_diagnostics_by_month(raw_usage(spark, d)),
        {"min_monthly_secs": 2, "max_monthly_secs": 2, "total_secs_sum": 2},
    )


@query
def clean_seconds_summary(spark, d):
    return rounded(
        checks.clean_seconds_summary(usage(spark, d)),
        {"minimum_monthly_seconds": 2, "maximum_monthly_seconds": 2, "total_clean_seconds": 2},
    )


@query
def monthly_tx_summary(spark, d):
    return checks.monthly_tx_summary(tx_monthly(spark, d))


@query
def anchor_coverage(spark, d):
    return checks.anchor_coverage(anchors(spark, d))


@query
def snapshot_churn_summary(spark, d):
    return rounded(checks.snapshot_churn_summary(snapshot(spark, d)), {"churn_rate": 6})


@query
def snapshot_cohort_checks(spark, d):
    return rounded(checks.snapshot_cohort_checks(snapshot(spark, d)), {"churn_rate": 6})


@query
def duplicate_keys(spark, d):
    """Customer and day keys that repeat in the logs."""
    return checks.duplicate_keys(A.all_logs(spark, d), ["msno", "date"])


@query
def feature_ranges(spark, d):
    return rounded(
        checks.feature_ranges(snapshot(spark, d)),
        {f"{e}_{c}": 2 for e in ("min", "max") for c in ("listening_secs_last3", "paid_amount_last3")},
    )


@query
def feature_missingness(spark, d):
    return checks.feature_missingness(snapshot(spark, d))


@query
def scored_checks(spark, d):
    return rounded(checks.scored_checks(late_scores(spark, d)), {"min_score": 6, "max_score": 6})


@query
def churn_by_band(spark, d):
    out = checks.churn_by_band(late_deciles(spark, d), A.cohort_labels(spark, d), "late")
    return rounded(out, {"observed_churn_rate": 6})


@query
def queue_checks(spark, d):
    return checks.queue_checks(io.without_label(outreach_queue(spark, d)))


@query
def batch_contract(spark, d):
    """Both cohorts together break the contract: ids repeat."""
    return checks.batch_contract(A.planted_scores(spark, d), required=["msno", "risk_score", "age"])


@query
def signal_bands(spark, d):
    out = signals.signal_bands(snapshot(spark, d))
    return out.select("msno", "cohort", *[s.band_column for s in signals.SIGNALS])


@query
def signal_rates(spark, d):
    return rounded(signals.signal_rates(snapshot(spark, d)), {"churn_rate": 6})


# --- model preparation -----------------------------------------------------


def _numeric_members(spark, d):
    """Snapshot columns with bad values of every kind."""
    return snapshot(spark, d).select("msno", "cohort", "age", "tenure_months_at_cutoff", "weighted_avg_plan_days_last3")


@query
def prepare_numeric(spark, d):
    """Raw daily seconds as a feature: infinite, missing and negative values occur."""
    raw = A.all_logs(spark, d).select(
        "msno", "date", "num_25", "num_100", "total_secs", (F.col("num_25") - 3).alias("tenure_months_at_cutoff")
    )
    out = prepare.prepare_numeric(raw, ["num_25", "num_100", "total_secs", "tenure_months_at_cutoff"])
    return rounded(out, {"total_secs": 1})


@query
def prepare_categories(spark, d):
    return prepare.prepare_categories(
        rollup.member_attributes(A.members(spark, d)).select("msno", *CATEGORIES)
    )


@query
def category_schema(spark, d):
    return prepare.category_schema(cohort(snapshot(spark, d), "early"))


@query
def align_categories(spark, d):
    """Levels of the urgent and high order priorities and statuses, applied to all orders."""
    orders = A.table(spark, d, "orders")
    known = prepare.category_schema(
        orders.where(F.col("o_orderpriority") < "3"), ["o_orderpriority", "o_orderstatus"]
    )
    return prepare.align_categories(
        orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"),
        known,
        ["o_orderpriority", "o_orderstatus"],
    )


@query
def stratified_split(spark, d):
    early = cohort(A.cohort_labels(spark, d), "early").select("msno", LABEL)
    return prepare.stratified_split(early)


@query
def stratified_sample(spark, d):
    early = cohort(A.cohort_labels(spark, d), "early").select("msno", LABEL)
    return prepare.stratified_sample(early, 100)


@query
def balanced_weights(spark, d):
    labelled = cohort(A.cohort_labels(spark, d), "late").select("msno", LABEL)
    return rounded(prepare.balanced_weights(labelled), {"weight": 6})


@query
def exact_quantiles(spark, d):
    lines = A.table(spark, d, "lineitem")
    out = rank.exact_quantiles(
        lines, ["l_quantity", "l_extendedprice"], [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    )
    return rounded(out, {"value": 4})


@query
def median_impute(spark, d):
    frame = durable(_numeric_members(spark, d))
    out = prepare.median_impute(frame, ["age", "tenure_months_at_cutoff", "weighted_avg_plan_days_last3"])
    return rounded(
        out.withColumns({c: F.col(c).cast("double") for c in ("age", "tenure_months_at_cutoff")}),
        {"weighted_avg_plan_days_last3": 6},
    )


@query
def scale_std(spark, d):
    frame = A.table(spark, d, "customer").select(A.customer_id("c_custkey"), "c_acctbal", "c_nationkey")
    return rounded(
        prepare.scale_std(frame, ["c_acctbal", "c_nationkey"]), {"c_acctbal": 6, "c_nationkey": 6}
    )


@query
def group_rare_levels(spark, d):
    frame = A.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return prepare.group_rare_levels(frame, ["s_nationkey"], min_rows=4)


# --- models ----------------------------------------------------------------


SIGNAL = "transactions_history"
#: Area under the curve that a model must reach; a tenth of the labels is turned around and the smallest cohort has a hundred rows.
FLOOR = 0.65


def _modelling_frame(spark, d):
    """Snapshots whose label is made from one feature, with a tenth of the labels turned around."""
    churned = F.col(SIGNAL) >= 8
    turned = F.crc32(F.col("msno").cast("binary")) % 10 == 0
    return snapshot(spark, d).withColumn(LABEL, (churned != turned).cast("int"))


def _model_split(spark, d):
    frame = durable(_modelling_frame(spark, d))
    split = prepare.stratified_split(cohort(frame, "early"))
    return split.where(F.col("split") == "train"), cohort(frame, "late")


def _judged(model, late):
    """Who was scored, whether the score is a probability, and whether the model tells the classes apart."""
    scored = durable(model.score(late).select("msno", LABEL, "risk_score"))
    auc = metrics.roc_auc(scored).first()[0]
    return scored.select("msno", F.col("risk_score").between(0, 1).alias("in_range"), F.lit(bool(auc >= FLOOR)).alias("separates"))


@query
def linear_scores(spark, d):
    train, late = _model_split(spark, d)
    return _judged(models.fit_linear(train), late)


@query
def boosted_scores(spark, d):
    train, late = _model_split(spark, d)
    return _judged(models.fit_boosted(train), late)


@query
def isotonic_scores(spark, d):
    scored = A.planted_scores(spark, d)
    model = models.fit_isotonic(cohort(scored, "early"))
    out = models.calibrate(model, cohort(scored, "late")).select("msno", "calibrated_score")
    return rounded(out, {"calibrated_score": 6})


@query
def permutation_importance(spark, d):
    train, late = _model_split(spark, d)
    found = durable(models.permutation_importance(models.fit_boosted(train), late, repeats=5))
    top = found.agg(F.max("average_precision_drop_mean")).first()[0]
    return found.select("feature", (F.col("average_precision_drop_mean") == top).alias("most_important"))


# --- evaluation ------------------------------------------------------------


@query
def average_precision(spark, d):
    return rounded(
        metrics.average_precision(A.planted_scores(spark, d), by=["cohort"]), {"average_precision": 6}
    )


@query
def roc_auc(spark, d):
    return rounded(metrics.roc_auc(A.planted_scores(spark, d), by=["cohort"]), {"roc_auc": 6})


@query
def ranking_quality_tied(spark, d):
    counts = metrics.score_counts(A.tied_scores(spark, d), by=["cohort"])
    out = counts.groupBy("cohort").agg(
        metrics.ap_of_counts().alias("average_precision"), metrics.auc_of_counts().alias("roc_auc")
    )
    return rounded(out, {"average_precision": 6, "roc_auc": 6})


@query
def document_quality_auc(spark, d):
    """How well text length tells apart good and poor documents."""
    labelled = A.table(spark, d, "labels").join(A.table(spark, d, "documents"), "doc_id")
    return rounded(metrics.roc_auc(labelled, label="quality", score="n_chars"), {"roc_auc": 6})


@query
def pr_curve(spark, d):
    out = metrics.pr_curve(A.planted_scores(spark, d), by=["cohort"])
    return rounded(out, {"precision": 6, "recall": 6, "threshold": 6})


@query
def topk_threshold(spark, d):
    out = metrics.topk_threshold(A.planted_scores(spark, d), 0.10, by=["cohort"])
    return rounded(out, {"threshold": 6})


@query
def threshold_metrics(spark, d):
    early = cohort(A.planted_scores(spark, d), "early")
    threshold = metrics.topk_threshold(early, 0.10).select("threshold").scalar()
    out = metrics.threshold_metrics(A.planted_scores(spark, d), threshold, by=["cohort"])
    return rounded(
        out, dict.fromkeys(("threshold", "flagged_share", "precision", "recall", "lift_at_threshold"), 6)
    )


RATES = dict.fromkeys(("churn_rate", "lift", "cumulative_churn_recall"), 6)


@query
def lift_table(spark, d):
    return rounded(metrics.lift_table(A.planted_scores(spark, d), by=["cohort"]), RATES)


@query
def lift_table_tied(spark, d):
    return rounded(metrics.lift_table(A.tied_scores(spark, d), by=["cohort"]), RATES)


@query
def cumulative_gains(spark, d):
    lift = metrics.lift_table(A.planted_scores(spark, d), by=["cohort"])
    return rounded(
        metrics.cumulative_gains(lift, by=["cohort"]), {"customer_share": 6, "churner_share": 6}
    )


@query
def brier_score(spark, d):
    return rounded(metrics.brier_score(A.planted_scores(spark, d), by=["cohort"]), {"brier_score": 6})


@query
def log_loss(spark, d):
    return rounded(metrics.log_loss(A.planted_scores(spark, d), by=["cohort"]), {"log_loss": 6})


@query
def calibration_bins(spark, d):
    return rounded(
        metrics.calibration_bins(late_scores(spark, d)), {"mean_score": 6, "observed_churn_rate": 6}
    )


@query
def calibration_bins_tied(spark, d):
    late = cohort(A.tied_scores(spark, d), "late")
    return rounded(metrics.calibration_bins(late), {"mean_score": 6, "observed_churn_rate": 6})


@query
def calibration_comparison(spark, d):
    scored = A.planted_scores(spark, d)
    calibrated = models.calibrate(models.fit_isotonic(cohort(scored, "early")), cohort(scored, "late"))
    out = metrics.calibration_comparison(
        calibrated, {"Raw model score": "risk_score", "Isotonic calibrated": "calibrated_score"}
    )
    return rounded(out, {"brier_score": 6, "log_loss": 6})


def _two_models(spark, d):
    period = F.when(F.col("cohort") == "early", "Internal validation").otherwise("Later cohort")
    planted = A.planted_scores(spark, d).withColumn("model", F.lit("Boosted trees"))
    tied = A.tied_scores(spark, d).withColumn("model", F.lit("Logistic baseline"))
    return durable(planted.unionByName(tied).withColumn("period", period))


@query
def model_metrics(spark, d):
    scored = _two_models(spark, d)
    chosen = metrics.topk_threshold(
        scored.where(F.col("period") == "Internal validation"), 0.10, by=["model"]
    )
    names = ("churn_rate", "average_precision", "roc_auc", "threshold", "flagged_share",
             "precision", "recall", "lift_at_threshold")
    return rounded(metrics.model_metrics(scored, chosen), dict.fromkeys(names, 6))


@query
def top_group_comparison(spark, d):
    lift = metrics.lift_table(_two_models(spark, d), by=["model", "period"])
    names = ("observed_churn_rate", "lift", "share_of_all_churners_captured")
    return rounded(metrics.top_group_comparison(lift), dict.fromkeys(names, 6))


# --- ranking and queue -----------------------------------------------------


@query
def risk_deciles(spark, d):
    return rounded(queue.risk_rank(late_scores(spark, d)), {"risk_score": 6})


@query
def risk_deciles_tied(spark, d):
    return rounded(
        queue.risk_rank(A.tied_scores(spark, d), by=["cohort"]), {"risk_score": 6}
    )


@query
def event_value_deciles(spark, d):
    """All events ranked by value; one event type may hold any share of them."""
    events = A.table(spark, d, "events").select("event_id", "event_type", "value")
    return queue.risk_rank(events, score="value", id_col="event_id", by=["event_type"])


@query
def risk_bands(spark, d):
    return late_deciles(spark, d).select("msno", "risk_decile", "risk_band")


@query
def risk_bands_variant(spark, d):
    deciles = queue.risk_rank(late_scores(spark, d))
    return queue.with_bands(deciles, BAND_CUTS_WIDE).select("msno", "risk_decile", "risk_band")


@query
def band_summary(spark, d):
    out = queue.band_summary(late_deciles(spark, d))
    return rounded(out, dict.fromkeys(("observed_churn_rate", "mean_risk_score", "lift_vs_overall"), 6))


@query
def band_counts(spark, d):
    return queue.band_counts(late_deciles(spark, d))


@query
def outreach_queue(spark, d):
    features = cohort(snapshot(spark, d), "late")
    out = queue.outreach_queue(late_deciles(spark, d), features, 0.10)
    return rounded(out, {**ROUNDED, "risk_score": 6})


@query
def top_decile_queue(spark, d):
    features = cohort(snapshot(spark, d), "late")
    out = queue.top_decile_queue(late_deciles(spark, d), features, REVIEW_ACTIONS)
    return rounded(out, {**ROUNDED, "risk_score": 6})


@query
def suggested_action(spark, d):
    return snapshot(spark, d).select(
        "msno", "cohort", queue.suggested_action().alias("suggested_action")
    )


@query
def scored_for_evaluation(spark, d):
    scored = late_deciles(spark, d).drop(LABEL)
    labelled = cohort(A.cohort_labels(spark, d), "late")
    return rounded(queue.scored_for_evaluation(scored, labelled), {"risk_score": 6})


@query
def score_batch(spark, d):
    """Train on the early cohort, score the late one end to end, read the outputs back."""
    train, late = _model_split(spark, d)
    folder = scratch_path(spark, "score-batch")
    models.fit_boosted(train).save(f"{folder}/model")
    io.write_table(late, f"{folder}/snapshot")
    scoring.score_batch(
        spark, f"{folder}/snapshot", f"{folder}/model", f"{folder}/out", cohort="late", share=0.10
    )
    scored = io.read_table(spark, f"{folder}/out/customer_risk_scores")
    queued = io.read_raw(spark, f"{folder}/out/outreach_queue").select("msno", F.lit(1).alias("_queued"))
    bands = scored.join(queued, "msno", "left").groupBy("risk_band").agg(
        F.count("*").alias("customers"), F.min("risk_rank").alias("first_rank"), F.max("risk_rank").alias("last_rank"),
        F.count("_queued").alias("queued"), F.min("risk_score").alias("_low"), F.max("risk_score").alias("_high"),
    )
    above = F.lag("_low").over(Window.orderBy("first_rank"))
    return bands.select("risk_band", "customers", "first_rank", "last_rank", "queued", F.coalesce(above >= F.col("_high"), F.lit(True)).alias("ordered"))


# --- integrity -------------------------------------------------------------


@query
def file_manifest(spark, d):
    return integrity.file_manifest(spark, d)


@query
def verify_manifest(spark, d):
    """Stored pages against a manifest in which some checksums are stale and some pages are gone."""
    pages = A.table(spark, d, "pages")
    path = F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html"))
    expected = pages.select(
        F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("old/"), path)).otherwise(path).alias("path"),
        F.sha2(F.when(F.col("page_id") % 5 == 0, F.col("url")).otherwise(F.col("html")), 256).alias("sha256"),
    )
    actual = pages.select(path.alias("path"), F.sha2("html", 256).alias("sha256"))
    return integrity.verify_manifest(
        actual, expected, required=["pages/1.html", "index.html"], forbidden=["/11.HTML", "secret"]
    )


# --- experiments and monitoring --------------------------------------------


def _routed(spark, d):
    features = cohort(snapshot(spark, d), "late")
    return features.select("msno", LABEL, experiment.action_route().alias("route"))


@query
def assign_arms(spark, d):
    return experiment.assign_arms(_routed(spark, d).select("msno", "route"))


@query
def itt_effect(spark, d):
    assigned = experiment.assign_arms(_routed(spark, d))
    out = experiment.itt_effect(assigned)
    return rounded(
        out, dict.fromkeys(("treatment_rate", "control_rate", "difference", "ci_low", "ci_high"), 6)
    )


@query
def balance_check(spark, d):
    assigned = experiment.assign_arms(_routed(spark, d))
    deciles = late_deciles(spark, d).select("msno", "risk_decile")
    out = experiment.balance_check(assigned.join(deciles, "msno"), ["risk_decile", "route"])
    return rounded(out, {"treatment_share": 6})


@query
def coverage_report(spark, d):
    frame = snapshot(spark, d)
    out = monitoring.coverage(
        cohort(frame, "late"), cohort(frame, "early"),
        ["age", "tenure_months_at_cutoff", "weighted_avg_plan_days_last3"], CATEGORIES,
    )
    return rounded(out, {"missing_share": 6, "reference_missing_share": 6, "unknown_share": 6})


@query
def feature_drift(spark, d):
    scored = A.planted_scores(spark, d)
    out = monitoring.drift(cohort(scored, "late"), cohort(scored, "early"), ["risk_score"])
    return rounded(out, {"psi": 6})


@query
def control_limits(spark, d):
    """Order months as batches: volume, repeat customers and value classes against the batch before."""
    orders = A.table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("run_id"),
        A.customer_id("o_custkey"),
        F.to_date("o_orderdate").alias("feature_date"),
        F.least(F.floor(F.col("o_totalprice") / 30000) + 1, F.lit(10)).alias("risk_decile"),
    )
    runs = monitoring.run_metrics(orders, "run_id", "msno", "feature_date")
    deciles = monitoring.decile_counts(orders, "run_id")
    return rounded(monitoring.control_limits(runs, 0.5, deciles, max_decile_shift=0.04), {"row_change": 6})
