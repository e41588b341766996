import random

import pytest

from ebbtide.operators import checks, snapshot
from ebbtide.spec import Cohort

USAGE = "msno string, month string, num_100 bigint, num_unq bigint, log_rows bigint, total_secs_clean double"
TX = ("msno string, month string, transaction_count bigint, paid_amount_sum double, avg_plan_days double, "
      "auto_renew_count bigint, cancel_count bigint")
ANCHORS = "msno string, cohort string, target_expiry_month string, is_churn int, anchor_expiry_date string"
MEMBERS = "msno string, city string, bd string, gender string, registered_via string, registration_init_time string"
# T-6, T-4, T-3, T-1, T and T+1 for T = 201702
MONTHS = ["201608", "201610", "201611", "201701", "201702", "201703"]


@pytest.fixture(scope="module")
def usage(spark):
    return spark.createDataFrame(
        [("a", m, 10**i, 1, 10**i, float(10**i)) for i, m in enumerate(MONTHS)]
        + [("a", "201607", 7, 7, 7, 7.0), ("late", "201703", 1, 1, 1, 1.0)],
        USAGE,
    )


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(
        [("a", "201611", 1, 5.0, 30.0, 1, 0), ("a", "201612", 3, 7.0, None, 2, 1), ("a", "201608", 2, 1.0, 90.0, 0, 0),
         ("n", "201701", 2, 1.0, None, 0, 0)],
        TX,
    )


@pytest.fixture(scope="module")
def anchors(spark):
    return spark.createDataFrame(
        [("a", "c", "201702", 1, "20170210"), ("late", "c", "201702", 0, None), ("n", "c", "201702", 0, None),
         ("none", "c", "201702", 0, None)],
        ANCHORS,
    )


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(
        [("a", "1", "12", "", "3", "20160115"), ("late", "2", "13", None, "3", "20170301"),
         ("n", "3", "101", "male", "4", "bad")],
        MEMBERS,
    )


def by_id(df):
    return {r.msno: r.asDict() for r in df.collect()}


def test_window_bounds(anchors, usage):
    found = by_id(snapshot.usage_features(anchors, usage))
    a = found["a"]
    assert a["log_rows_last_month"] == 1000
    assert a["listening_secs_last3"] == 1100.0
    assert a["listening_secs_prev3"] == 11.0
    assert a["listening_secs_last6"] == 1111.0
    assert a["completed_plays_last3"] == 1100
    assert a["daily_unique_song_sum_last3"] == 2
    assert (a["active_months_last3"], a["active_months_prev3"]) == (2, 2)
    assert a["log_rows_history"] == 1111 + 7
    assert found["late"]["log_rows_history"] == 0 and found["none"]["active_months_last3"] == 0


def test_weighted_plan_days_count_months_without_an_average(anchors, tx):
    found = by_id(snapshot.transaction_features(anchors, tx))
    assert found["a"]["weighted_avg_plan_days_last3"] == 30.0 / 4
    assert found["a"]["transactions_history"] == 6 and found["a"]["transactions_prev3"] == 2
    assert found["n"]["weighted_avg_plan_days_last3"] is None
    assert found["none"]["weighted_avg_plan_days_last3"] is None


def test_missing_average_is_zero_when_other_months_exist(spark, anchors):
    tx = spark.createDataFrame(
        [("a", "201701", 2, 1.0, None, 0, 0), ("a", "201601", 1, 1.0, 30.0, 0, 0)], TX
    )
    assert by_id(snapshot.transaction_features(anchors, tx))["a"]["weighted_avg_plan_days_last3"] == 0.0


def test_snapshot_row(anchors, usage, tx, members):
    found = by_id(snapshot.build_snapshot(anchors, usage, tx, members))
    assert found["a"]["age"] is None and found["late"]["age"] == 13 and found["n"]["age"] is None
    assert found["a"]["tenure_months_at_cutoff"] == 13
    assert found["late"]["tenure_months_at_cutoff"] == -1
    assert found["n"]["tenure_months_at_cutoff"] is None
    assert found["none"]["paid_amount_last3"] == 0.0 and found["none"]["city"] is None
    assert found["a"]["paid_amount_last3"] == 12.0 and found["a"]["listening_secs_last3"] == 1100.0


def test_fused_snapshot_equals_its_parts(anchors, usage, tx, members):
    fused = by_id(snapshot.build_snapshot(anchors, usage, tx, members))
    for part in (snapshot.usage_features(anchors, usage), snapshot.transaction_features(anchors, tx)):
        for msno, row in by_id(part).items():
            for name, value in row.items():
                expected = 0 if value is None and name != "weighted_avg_plan_days_last3" else value
                assert fused[msno][name] == expected, (msno, name)


def test_conflicting_labels_double_the_sums_but_not_the_counts(spark, usage, tx, members):
    twice = spark.createDataFrame(
        [("a", "c", "201702", 0, None), ("a", "c", "201702", 1, None)], ANCHORS
    )
    both = snapshot.build_snapshot(twice, usage, tx, members)
    assert both.count() == 2
    for r in both.collect():
        assert r.listening_secs_last3 == 2200.0 and r.transactions_history == 12
        assert r.active_months_last3 == 2 and r.weighted_avg_plan_days_last3 == 7.5
    part = snapshot.usage_features(twice, usage).collect()
    assert len(part) == 1 and part[0].listening_secs_last3 == 2200.0 and part[0].active_months_last3 == 2
    assert checks.duplicate_keys(both, ["cohort", "msno"]).first()[0] == 1


def test_repeated_month_rows_count_once_as_active(spark, anchors, usage):
    again = usage.unionByName(spark.createDataFrame([("a", "201701", 1, 1, 1, 1.0)], USAGE))
    a = by_id(snapshot.usage_features(anchors, again))["a"]
    assert a["active_months_last3"] == 2 and a["log_rows_last_month"] == 1001


def test_nothing_after_the_cutoff_leaks(spark, anchors, usage, tx, members):
    before = snapshot.build_snapshot(anchors, usage, tx, members).orderBy("msno").collect()
    noise = random.Random(7)
    later_usage = [(m, f"2017{noise.randint(2, 12):02d}", 9, 9, 9, 99.0) for m in ("a", "none", "n") for _ in range(20)]
    later_tx = [(m, f"2017{noise.randint(2, 12):02d}", 9, 9.0, 9.0, 9, 9) for m in ("a", "none") for _ in range(20)]
    after = snapshot.build_snapshot(
        anchors,
        usage.where("month < '201702'").unionByName(spark.createDataFrame(later_usage, USAGE)),
        tx.unionByName(spark.createDataFrame(later_tx, TX)),
        members,
    )
    assert after.orderBy("msno").collect() == before


def test_many_cutoffs_equal_single_cutoffs(spark, usage, tx, members, rows):
    events = spark.createDataFrame([("a", "20161231"), ("a", "20170210")], "msno string, membership_expire_date string")
    ids = spark.createDataFrame([("a",), ("n",)], "msno string")
    cutoffs = [Cohort("x", "201612"), Cohort("y", "201702"), Cohort("z", "201704")]
    together = snapshot.multi_cutoff_snapshot(ids, cutoffs, usage, events, tx, members)
    for c in cutoffs:
        alone = snapshot.multi_cutoff_snapshot(ids, [c], usage, events, tx, members)
        assert rows(together.where(f"cohort = '{c.name}'")) == rows(alone)
    assert rows(together.where("msno = 'a'"), "cohort", "anchor_expiry_date") == [
        ("x", "20161231"), ("y", "20170210"), ("z", None),
    ]
