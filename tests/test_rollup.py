import pytest
from pyspark.errors import PySparkException

from ebbtide.operators import checks, profile, rollup
from ebbtide.spec import LOG_COUNTERS, Cohort

INF, NAN = float("inf"), float("nan")
LOG_SCHEMA = "msno string, date string, " + ", ".join(f"{c} int" for c in LOG_COUNTERS) + ", total_secs double"


def log(msno, date, secs, n=1):
    return (msno, date, n, n, n, n, n, n, secs)


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(
        [
            log("a", "20170101", 10.0),
            log("a", "20170102", -0.01),
            log("a", "20170103", NAN),
            log("a", "20170104", None),
            log("a", "20170105", 86400.0),
            log("a", "20170106", 86400.01),
            log("a", "20170107", 1e12),
            log("b", "20170101", INF),
            log("b", "20170102", -INF),
            log("b", "20170201", 0.0),
            log("c", None, 5.0),
            log(None, "20170101", 5.0),
        ],
        LOG_SCHEMA,
    )


def test_raw_seconds_skip_missing_and_keep_infinities(logs, rows):
    usage = rollup.monthly_usage(logs)
    found = rows(usage, "msno", "month", "log_rows", "num_unq", "total_secs")
    assert found[0][:4] == ("a", "201701", 7, 7)
    assert found[0][4] == pytest.approx(10.0 - 0.01 + 86400 + 86400.01 + 1e12)
    assert found[1][:4] == ("b", "201701", 2, 2) and found[1][4] != found[1][4]
    assert found[2] == ("b", "201702", 1, 1, 0.0)
    assert len(found) == 3


def test_clean_seconds(logs, rows):
    clean = rollup.monthly_clean_seconds(logs)
    assert rows(clean) == [
        ("a", "201701", 10.0 + 3 * 86400.0, 3, 2),
        ("b", "201701", 0.0, 2, 0),
        ("b", "201702", 0.0, 0, 0),
    ]


def test_one_pass_equals_merge(logs, rows):
    merged = rollup.merge_clean_seconds(rollup.monthly_usage(logs), rollup.monthly_clean_seconds(logs))
    at_once = rollup.monthly_clean_usage(logs)
    assert at_once.columns == merged.columns
    assert rows(at_once) == rows(merged)
    assert "total_secs" in rollup.monthly_clean_usage(logs, keep_raw=True).columns


def test_months_without_correction_get_zero(spark, logs, rows):
    clean = rollup.monthly_clean_seconds(logs.where("msno = 'a'"))
    merged = rollup.merge_clean_seconds(rollup.monthly_usage(logs), clean)
    assert [r[2:] for r in rows(merged, "msno", "month", "total_secs_clean", "invalid_secs_rows") if r[0] == "b"] == [
        (0.0, 0), (0.0, 0),
    ]


def test_bad_counters_become_null_or_fail(spark, rows):
    text = spark.createDataFrame(
        [("a", "20170101", "1", "x", "", "2", "1.6", "3", "9")],
        "msno string, date string, " + ", ".join(f"{c} string" for c in LOG_COUNTERS) + ", total_secs string",
    )
    assert rows(rollup.monthly_usage(text), *LOG_COUNTERS) == [(1, None, None, 2, 2, 3)]
    with pytest.raises(PySparkException):
        rollup.monthly_usage(text, bad_numbers="error").collect()
    assert rows(profile.unreadable_values(text, ["num_25", "num_50", "num_75"])) == [
        ("num_25", 0), ("num_50", 1), ("num_75", 1),
    ]


TX = "msno string, payment_method_id string, payment_plan_days string, plan_list_price string, actual_amount_paid string, is_auto_renew string, transaction_date string, membership_expire_date string, is_cancel string"


def tx(msno, day, expiry, method="41", days="30", price="149", paid="149", auto="1", cancel="0"):
    return (msno, method, days, price, paid, auto, day, expiry, cancel)


def test_duplicates_are_compared_as_text_and_by_column_name(spark):
    first = spark.createDataFrame([tx("a", "20170101", "20170201"), tx("a", "20170101", "20170201", cancel="00")], TX)
    swapped = spark.createDataFrame([tx("a", "20170101", "20170201")], TX).select(*reversed(first.columns))
    lacking = spark.createDataFrame([tx("a", "20170101", "20170201")], TX).drop("is_cancel")
    assert rollup.dedupe_events(first, swapped).count() == 2
    found = rollup.dedupe_events(first, swapped, lacking)
    assert found.count() == 3 and found.where("is_cancel is null").count() == 1


def test_monthly_transactions(spark, rows):
    df = spark.createDataFrame(
        [
            tx("a", "20170105", "20170205", days="30", paid="100"),
            tx("a", "20170120", "20170220", method="38", days="bad", paid="50.5", auto="0", cancel="1"),
            tx("a", "20171399", "20170220"),
            tx("a", "20170231", "20170220"),
            tx("b", "20170201 ", "20170301", days="", price="x"),
        ],
        TX,
    )
    assert rows(rollup.monthly_transactions(df)) == [
        ("a", "201701", 2, 150.5, 298.0, 30.0, 1, 1, 2),
        ("b", "201702", 1, 149.0, None, None, 1, 0, 1),
    ]
    assert rows(checks.monthly_tx_summary(rollup.monthly_transactions(df))) == [(2, 2, "201701", "201702")]


def test_anchor_is_latest_expiry_in_target_month(spark, rows):
    labels = spark.createDataFrame(
        [("a", "c", "201702", 0), ("a", "c", "201702", 1), ("b", "c", "201702", 0), ("d", "c", "201702", None)],
        "msno string, cohort string, target_expiry_month string, is_churn int",
    )
    df = spark.createDataFrame(
        [tx("a", "20170101", "20170205"), tx("a", "20170101", "20170220"), tx("a", "20170101", "20170301"),
         tx("b", "20170101", "20170231"), tx("d", "bad", "20170228")],
        TX,
    )
    assert rows(rollup.cohort_anchors(labels, df), "msno", "is_churn", "anchor_expiry_date") == [
        ("a", 0, "20170220"), ("a", 1, "20170220"), ("b", 0, None), ("d", None, "20170228"),
    ]


def test_cohort_labels_and_ids(spark, rows):
    tables = {
        "train": spark.createDataFrame([("a", "1"), ("b", "x"), (None, "0")], "msno string, is_churn string"),
        "train_v2": spark.createDataFrame([("b", "0")], "msno string, is_churn string"),
    }
    cohorts = [Cohort("train", "201702"), Cohort("train_v2", "201703")]
    assert rows(rollup.cohort_labels(tables, cohorts)) == [
        (None, "train", "201702", 0), ("a", "train", "201702", 1), ("b", "train", "201702", None),
        ("b", "train_v2", "201703", 0),
    ]
    assert rows(profile.cohort_ids(tables)) == [("a",), ("b",)]
    assert rows(profile.cohort_sizes(tables)) == [("train", 3, 2), ("train_v2", 1, 1)]


def test_restrict_keeps_each_row_once(spark):
    ids = spark.createDataFrame([("a",), ("a",)], "msno string")
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "msno string, x int")
    assert [tuple(r) for r in rollup.restrict_to(df, ids).collect()] == [("a", 1)]


def test_members_take_the_largest_attribute(spark, rows):
    df = spark.createDataFrame(
        [("a", "1.6", "20", "female", "3", "20160101"), ("a", "1", "abc", None, "4", "20150101"),
         ("b", "", None, "", None, None)],
        "msno string, city string, bd string, gender string, registered_via string, registration_init_time string",
    )
    assert rows(rollup.member_attributes(df)) == [
        ("a", 2, 20, "female", "4", "20160101"), ("b", None, None, "", None, None),
    ]


def test_anomalies_count_non_finite_first(spark, logs, rows):
    ids = spark.createDataFrame([("a",), ("b",)], "msno string")
    found = profile.value_anomalies({"logs": logs}, "total_secs", ids)
    assert rows(found) == [("logs", 12, 10, -0.01, 1e12, 1, 2, 4)]
    none = profile.value_anomalies({"logs": logs}, "total_secs", ids.where("false"))
    assert rows(none) == [("logs", 12, 0, None, None, 0, 0, 0)]
    examples = profile.anomaly_examples({"logs": logs}, "total_secs", ids, n=3)
    assert rows(examples, "msno", "date") == [("a", "20170102"), ("a", "20170103"), ("a", "20170104")]


def test_date_audits_use_their_own_rules(spark, rows):
    df = spark.createDataFrame([("20170101",), ("20171399",), (" 20161231 ",), ("2017AB01",), ("1",), (None,)], "d string")
    assert rows(profile.date_coverage(df, "d")) == [(6, "20161231", "20171399")]
    assert rows(profile.rows_by_period(df, "d")) == [("201612", 1), ("201701", 1), ("201713", 1)]
    assert rows(profile.date_range_by_source({"s": df}, ["d"])) == [("s", 6, "20170101", "2017AB01")]


def test_expiry_match_lists_every_cohort_and_source(spark, rows):
    labels = {
        "x": spark.createDataFrame([("a",), ("a",), ("b",)], "msno string"),
        "y": spark.createDataFrame([("a",)], "msno string"),
    }
    sources = {
        "v1": spark.createDataFrame([("a", "20170201"), ("a", "20170202"), ("z", "20170201")],
                                    "msno string, membership_expire_date string"),
        "v2": spark.createDataFrame([("a", "20170301")], "msno string, membership_expire_date string"),
    }
    found = profile.expiry_match(sources, labels, [Cohort("x", "201702"), Cohort("y", "201703")])
    assert rows(found) == [
        ("x", "v1", 2, 1, 1, "20170201", "20170202"), ("x", "v2", 0, 0, 2, None, None),
        ("y", "v1", 0, 0, 1, None, None), ("y", "v2", 1, 1, 0, "20170301", "20170301"),
    ]
