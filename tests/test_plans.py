"""Plans that have to hold when nothing is small enough to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import profile, rollup, snapshot
from tests.test_snapshot import ANCHORS, MEMBERS, TX, USAGE


@pytest.fixture
def no_broadcast(spark):
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    yield
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(key)


@pytest.fixture
def stored(spark, tmp_path):
    def table(schema, name):
        path = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(path)
        return spark.read.parquet(path)

    return table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_snapshot_shuffles_each_input_once_by_customer(no_broadcast, stored):
    plan = plan_of(
        snapshot.build_snapshot(
            stored(ANCHORS, "a"), stored(USAGE, "u"), stored(TX, "t"), stored(MEMBERS, "m"), before="201703"
        )
    )
    shuffles = re.findall(r"Exchange (\w+)\((\w+)#", plan)
    assert shuffles == [("hashpartitioning", "msno")] * 3
    assert "LessThan(month,201703)" in plan and "Python" not in plan


def test_cohort_filter_follows_the_roll_up(no_broadcast, stored):
    logs = stored(
        "msno string, date string, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
        "total_secs double, note string", "logs")
    plan = plan_of(rollup.restrict_to(rollup.monthly_clean_usage(logs), stored("msno string", "ids")))
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate(keys=[msno")
    assert "partial_sum" in plan and "note" not in re.findall(r"ReadSchema: (\S+)", plan)[0]


def test_examples_are_limited_before_every_shuffle(no_broadcast, stored):
    logs = stored("msno string, date string, total_secs double", "logs")
    plan = plan_of(profile.anomaly_examples({"a": logs, "b": logs}, "total_secs", stored("msno string", "ids")))
    assert len(re.findall(r"row_number\(\), 20, Partial", plan)) == 2


def test_roll_ups_of_raw_events_do_not_sort_them(no_broadcast, stored):
    tx = stored(", ".join(f"{c} string" for c in rollup.TRANSACTION_COLUMNS), "tx")
    assert "SortAggregate" not in plan_of(rollup.monthly_transactions(rollup.dedupe_events(tx, tx)))
    labels = stored("msno string, cohort string, target_expiry_month string, is_churn int", "labels")
    assert "SortAggregate" not in plan_of(rollup.cohort_anchors(labels, tx))


def test_numbers_are_not_matched_as_text(spark):
    """The pattern for numeric text stays out of plans over columns of numbers."""
    typed = spark.createDataFrame([], "msno string, date string, num_25 int, num_50 bigint, num_75 int, num_985 int, num_100 int, num_unq decimal(9,0), total_secs double")
    text = typed.select(*[F.col(c).cast("string").alias(c) for c in typed.columns])
    for logs, expected in ((typed, False), (text, True)):
        plan = rollup.monthly_clean_usage(logs)._jdf.queryExecution().optimizedPlan().toString()
        assert ("RLIKE" in plan) == expected


def test_customer_stages_keep_their_partitions(spark, no_broadcast, stored):
    """Spark must not merge the partitions of the stage that holds a customer's months many times over."""
    kinds = {t.name: t.dataType for t in stored(USAGE, "u").schema}
    days = spark.createDataFrame([(f"u{i}", m) for i in range(200) for m in ("201611", "201612")], "msno string, month string")
    usage = days.select(*[F.col(c) if c in days.columns else F.lit(1).cast(kind).alias(c) for c, kind in kinds.items()])
    anchors = spark.createDataFrame([(f"u{i}", "c", "201703") for i in range(200)], "msno string, cohort string, target_expiry_month string")
    found = snapshot.usage_features(anchors, usage).withColumn("part", F.spark_partition_id()).collect()
    assert len(found) == 200 and len({r.part for r in found}) > 1
