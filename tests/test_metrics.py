import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import checks, metrics, queue


def frame(spark, labels, scores):
    return spark.createDataFrame(
        [(f"id{i:04d}", int(y), float(s)) for i, (y, s) in enumerate(zip(labels, scores))],
        "msno string, is_churn int, risk_score double",
    ).repartition(4)


def brute(labels, scores):
    """Average precision and AUC straight from their definitions."""
    positives = sum(labels)
    negatives = len(labels) - positives
    ap, reached = 0.0, 0
    for t in sorted(set(scores), reverse=True):
        called = [y for y, s in zip(labels, scores) if s >= t]
        ap += (sum(called) - reached) / positives * sum(called) / len(called)
        reached = sum(called)
    wins = sum(
        (a > b) + (a == b) / 2
        for y, a in zip(labels, scores) if y
        for z, b in zip(labels, scores) if not z
    )
    return ap, wins / (positives * negatives)


CASES = {
    "continuous": lambda r: r.random(),
    "tied": lambda r: r.randint(0, 5) / 5,
    "constant": lambda r: 0.3,
}


@pytest.fixture(scope="module", params=list(CASES))
def case(request, spark):
    noise = random.Random(11)
    scores = [CASES[request.param](noise) for _ in range(120)]
    labels = [int(noise.random() < 0.2 + 0.5 * s) for s in scores]
    return labels, scores, frame(spark, labels, scores)


def test_ap_and_auc(case):
    labels, scores, df = case
    ap, auc = brute(labels, scores)
    assert metrics.average_precision(df).first()[0] == pytest.approx(ap)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(auc)


def test_monotone_maps_change_nothing(case):
    _, _, df = case
    mapped = df.withColumn("risk_score", F.exp(F.col("risk_score") * 3) - 7)
    assert metrics.average_precision(mapped).first() == metrics.average_precision(df).first()
    assert metrics.roc_auc(mapped).first() == metrics.roc_auc(df).first()


def test_pr_curve_has_a_point_per_score_and_an_end(case):
    labels, scores, df = case
    points = metrics.pr_curve(df).orderBy(F.col("threshold").asc_nulls_last()).collect()
    assert len(points) == len(set(scores)) + 1
    assert tuple(points[-1]) == (1.0, 0.0, None)
    assert points[0].recall == 1.0 and points[0].precision == pytest.approx(sum(labels) / len(labels))


def test_threshold_takes_ties_along(case):
    labels, scores, df = case
    k = math.ceil(0.1 * len(scores))
    t = metrics.topk_threshold(df, 0.1).first()
    assert t.threshold == sorted(scores)[-k] and t.k == k
    m = metrics.threshold_metrics(df, t.threshold).first()
    called = [y for y, s in zip(labels, scores) if s >= t.threshold]
    assert m.customers_flagged == len(called) >= k
    assert m.precision == pytest.approx(sum(called) / len(called))
    assert m.recall == pytest.approx(sum(called) / sum(labels))
    assert m.lift_at_threshold == pytest.approx(m.precision / (sum(labels) / len(labels)))


def test_lift_table_adds_up(case):
    labels, scores, df = case
    table = metrics.lift_table(df).collect()
    assert [r.customers for r in table] == [12] * 10
    assert table[-1].cumulative_customers == 120 and table[-1].cumulative_churners == sum(labels)
    assert table[-1].cumulative_churn_recall == 1.0
    order = sorted(zip([-s for s in scores], [f"id{i:04d}" for i in range(120)], labels))
    assert table[0].churners == sum(y for _, _, y in order[:12])
    gains = metrics.cumulative_gains(metrics.lift_table(df)).collect()
    assert [round(g.customer_share, 9) for g in gains] == [round((i + 1) / 10, 9) for i in range(10)]


def test_single_class_has_no_ranking_metrics(spark):
    only = frame(spark, [0, 0, 0], [0.1, 0.2, 0.3])
    assert metrics.average_precision(only).first()[0] is None
    assert metrics.roc_auc(only).first()[0] is None
    m = metrics.threshold_metrics(only, 0.2).first()
    assert (m.precision, m.recall, m.lift_at_threshold, m.customers_flagged) == (0.0, 0.0, 0.0, 2)
    lift = metrics.lift_table(only).collect()
    assert {r.lift for r in lift} == {None} and {r.cumulative_churn_recall for r in lift} == {None}


def test_missing_scores_come_last(spark):
    rows = [("a", 1, 0.9), ("b", 0, float("nan")), ("c", 1, None), ("d", 0, 0.1)]
    df = spark.createDataFrame(rows, "msno string, is_churn int, risk_score double")
    ranks = {r.msno: (r.risk_rank, r.risk_decile) for r in queue.risk_rank(df, groups=4).collect()}
    assert ranks == {"a": (1, 1), "d": (2, 2), "b": (3, 3), "c": (4, 4)}
    assert metrics.threshold_metrics(df, 0.5).first().customers_flagged == 1
    assert metrics.topk_threshold(df, 0.25).first().threshold == 0.9
    assert [tuple(r) for r in checks.batch_contract(df, ["msno"]).collect()] == [("missing scores", "2")]


def test_nobody_flagged_is_zero(spark):
    m = metrics.threshold_metrics(frame(spark, [0, 1], [0.1, 0.2]), 0.9).first()
    assert (m.customers_flagged, m.flagged_share, m.precision, m.recall) == (0, 0.0, 0.0, 0.0)


def test_brier_and_log_loss(spark):
    labels, scores = [0, 1, 1, 0], [0.0, 1.0, 0.25, 0.5]
    df = frame(spark, labels, scores)
    assert metrics.brier_score(df).first()[0] == pytest.approx((0 + 0 + 0.5625 + 0.25) / 4)
    p = np.clip(scores, 1e-6, 1 - 1e-6)
    expected = -np.mean([y * math.log(q) + (1 - y) * math.log(1 - q) for y, q in zip(labels, p)])
    assert metrics.log_loss(df).first()[0] == pytest.approx(expected)
    both = metrics.calibration_comparison(df, {"x": "risk_score"}).first()
    assert both.log_loss == pytest.approx(expected)


@pytest.mark.parametrize("scores", [
    [i / 50 for i in range(50)],
    [0.1] * 30 + [i / 20 for i in range(20)],
    [0.5] * 10,
])
def test_calibration_bins_match_interpolated_quantile_cuts(spark, scores):
    labels = [i % 3 == 0 for i in range(len(scores))]
    found = metrics.calibration_bins(frame(spark, labels, scores)).collect()
    edges = np.unique(np.quantile(scores, np.linspace(0, 1, 11)))
    bins = np.maximum(1, np.searchsorted(edges, scores, side="left"))
    counts = {int(b): int(c) for b, c in zip(*np.unique(bins, return_counts=True))}
    assert {r.bin: r.customers for r in found} == counts
    assert sum(r.customers for r in found) == len(scores)


def test_model_metrics_agree_with_single_metrics(spark, rows):
    noise = random.Random(2)
    data = [
        (f"id{i}", m, p, int(noise.random() < 0.3), noise.randint(0, 9) / 9)
        for m in ("x", "y") for p in ("val", "late") for i in range(60)
    ]
    df = spark.createDataFrame(data, "msno string, model string, period string, is_churn int, risk_score double")
    thresholds = metrics.topk_threshold(df.where("period = 'val'"), 0.1, by=["model"])
    found = metrics.model_metrics(df, thresholds).collect()
    assert len(found) == 4
    at = {r.model: r.threshold for r in thresholds.collect()}
    for r in found:
        part = df.where((F.col("model") == r.model) & (F.col("period") == r.period))
        single = metrics.threshold_metrics(part, at[r.model]).first().asDict()
        for name, value in single.items():
            assert r[name] == pytest.approx(value), name
        assert r.average_precision == pytest.approx(metrics.average_precision(part).first()[0])
        assert r.roc_auc == pytest.approx(metrics.roc_auc(part).first()[0])
        assert r.customers == 60


def test_bands_cover_everyone(spark):
    df = frame(spark, [i % 2 for i in range(33)], [i / 33 for i in range(33)])
    banded = queue.with_bands(queue.risk_rank(df))
    assert sum(r.customers for r in queue.band_counts(banded).collect()) == 33
    summary = queue.band_summary(banded).collect()
    assert [(r.risk_decile, r.risk_band) for r in summary] == [
        (1, "High"), (2, "Elevated"), *[(d, "Moderate") for d in range(3, 7)], *[(d, "Low") for d in range(7, 11)],
    ]
    assert sum(r.customers for r in summary) == 33


def test_missing_scores_come_last_in_curves(spark):
    """Neither NaN nor NULL outranks a score, and neither is a threshold."""
    data = [(0, float("nan")), (1, 0.9), (0, 0.1), (1, 0.8), (0, None)]
    df = spark.createDataFrame(data, "is_churn int, risk_score double")
    assert metrics.average_precision(df).first()[0] == 1.0
    assert metrics.roc_auc(df).first()[0] == 1.0
    curve = sorted((r.threshold is None, r.threshold or 0, r.precision, r.recall) for r in metrics.pr_curve(df).collect())
    assert curve == [(False, 0.1, pytest.approx(2 / 3), 1.0), (False, 0.8, 1.0, 1.0), (False, 0.9, 1.0, 0.5), (True, 0, 1.0, 0.0)]
