import pytest

from ebbtide.operators import checks, lookup, prepare, queue, signals
from ebbtide.spec import BATCH_ACTIONS, QUEUE_SIGNALS, SIGNALS, BAND_CUTS_WIDE


def test_numeric_cleaning(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(0, "1.5", -1.0), (1, "x", 0.0), (2, None, inf), (3, "inf", float("nan")), (4, "-2", 3.0)],
        "i int, age string, tenure_months_at_cutoff double",
    )
    out = prepare.prepare_numeric(df, ["age", "tenure_months_at_cutoff"]).orderBy("i").collect()
    assert [r.age for r in out] == [1.5, None, None, None, -2.0]
    assert [r.tenure_months_at_cutoff for r in out] == [None, 0.0, None, None, 3.0]


def test_categories_and_schema(spark, rows):
    df = spark.createDataFrame([(13, "male"), (4, ""), (None, None), (4, "male")], "city int, gender string")
    prepared = prepare.prepare_categories(df, ["city", "gender"])
    assert rows(prepared) == [("13", "male"), ("4", "Unknown"), ("4", "male"), ("Unknown", "Unknown")]
    schema = prepare.category_schema(df, ["city", "gender"])
    assert rows(schema) == [
        ("city", "13", 0), ("city", "4", 1), ("city", "Unknown", 2), ("gender", "Unknown", 0), ("gender", "male", 1),
    ]
    later = spark.createDataFrame([(99, "male"), (4, "other"), (None, "")], "city int, gender string")
    assert rows(prepare.align_categories(later, schema, ["city", "gender"])) == [
        (None, "male"), ("4", None), ("Unknown", "Unknown"),
    ]


def test_rare_levels_share_one_level_and_unknown_ones_none(spark):
    df = spark.createDataFrame([("a",)] * 20 + [("b",)] * 19 + [("c",)] * 3, "city string")
    fitted = prepare.group_rare_levels(df, ["city"])
    assert {r[0]: r[1] for r in fitted.groupBy("city").count().collect()} == {"a": 20, "infrequent": 22}
    other = spark.createDataFrame([("a",), ("b",), ("new",)], "city string")
    mapped = prepare.group_rare_levels(other, ["city"], fit_on=df).collect()
    assert sorted((r[0] for r in mapped), key=str) == [None, "a", "infrequent"]


def test_median_fill_scale_and_weights(spark, rows):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, 2.0), (10.0, 2.0)], "a double, b double")
    out = prepare.median_impute(df, ["a", "b"])
    assert out.columns == ["a", "b", "a_missing"]
    assert rows(out) == [(1.0, 2.0, 0.0), (3.0, 2.0, 0.0), (3.0, 2.0, 1.0), (10.0, 2.0, 0.0)]
    scaled = rows(prepare.scale_std(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double"), ["a", "b"]))
    assert scaled == [(1.0, 5.0), (3.0, 5.0)]
    labels = spark.createDataFrame([(0,)] * 3 + [(1,)], "is_churn int")
    assert rows(prepare.class_weights(labels)) == [(0, 3, 4 / 6), (1, 1, 2.0)]


def test_signals_send_missing_and_negative_to_the_rest(spark):
    columns = sorted({s.column for s in SIGNALS})
    df = spark.createDataFrame(
        [("c", 1, *[0] * len(columns)), ("c", 0, *[None] * len(columns)), ("c", 0, *[-1] * len(columns)),
         ("c", None, *[1] * len(columns))],
        "cohort string, is_churn int, " + ", ".join(f"{c} bigint" for c in columns),
    )
    found = {(r.signal, r.band): (r.customers, r.churners, r.churn_rate) for r in signals.signal_rates(df).collect()}
    auto = "Auto-renew transactions, last 3 months"
    assert found[auto, "0"] == (1, 1, 1.0)
    assert found[auto, "1"] == (1, None, None)
    assert found[auto, "2+"] == (2, 0, 0.0)
    assert found["Cancellation transactions, last 3 months", "1+"] == (3, 0, 0.0)
    for s in SIGNALS:
        assert sum(v[0] for k, v in found.items() if k[0] == s.signal) == 4


def queue_frame(spark, data):
    return spark.createDataFrame(data, "msno string, " + ", ".join(f"{c} double" for c in QUEUE_SIGNALS))


def test_first_matching_action_wins_and_missing_never_matches(spark):
    cancel, auto, tx, paid, secs = range(5)
    base = [0.0, 1.0, 1.0, 1.0, 1.0]

    def case(name, **changes):
        values = list(base)
        for key, v in changes.items():
            values[{"cancel": cancel, "auto": auto, "tx": tx, "paid": paid, "secs": secs}[key]] = v
        return (name, *values)

    df = queue_frame(spark, [
        case("cancel", cancel=1.0, auto=0.0, secs=0.0), case("auto", auto=0.0, secs=0.0), case("tx", tx=0.0),
        case("paid", paid=0.0), case("secs", secs=0.0), case("fine"),
        case("null", cancel=None, auto=None, tx=None, paid=None, secs=None),
    ])
    found = {r[0]: r[1] for r in df.select("msno", queue.suggested_action().alias("x")).collect()}
    t = BATCH_ACTIONS
    assert found == {"cancel": t.cancellation, "auto": t.renewal, "tx": t.renewal, "paid": t.renewal,
                     "secs": t.adoption, "fine": t.personal, "null": t.personal}


@pytest.mark.parametrize("share, size", [(0.1, 2), (0.01, 1), (1.0, 11)])
def test_queue_size_order_and_columns(spark, share, size):
    features = queue_frame(spark, [(f"c{i:02d}", 0.0, 1.0, 1.0, 1.0, 1.0) for i in range(11)])
    scores = spark.createDataFrame([(f"c{i:02d}", i / 11, 1) for i in range(11)], "msno string, risk_score double, is_churn int")
    scored = queue.with_bands(queue.risk_rank(scores))
    out = queue.outreach_queue(scored, features, share)
    assert out.columns == list(queue.QUEUE_COLUMNS)
    assert [r.msno for r in out.collect()] == [f"c{i:02d}" for i in range(10, 10 - size, -1)]
    assert queue.top_decile_queue(scored, features).count() == 2


@pytest.mark.parametrize("share", [0, -0.1, 1.01])
def test_queue_share_must_be_a_share(spark, share):
    with pytest.raises(ValueError):
        queue.check_share(share)


def test_wide_bands(spark):
    df = spark.createDataFrame([(d,) for d in range(1, 11)], "risk_decile int")
    bands = [r.risk_band for r in queue.with_bands(df, BAND_CUTS_WIDE).orderBy("risk_decile").collect()]
    assert bands == ["High"] + ["Elevated"] * 2 + ["Moderate"] * 3 + ["Low"] * 4


def test_contract(spark):
    good = spark.createDataFrame([("a", 1), ("b", 2)], "msno string, x int")
    assert checks.batch_contract(good, ["msno", "x"]).count() == 0
    assert checks.enforce_contract(good, ["msno"]).columns == ["msno"]
    empty = checks.batch_contract(good.where("false"), ["msno", "x"]).collect()
    assert [tuple(r) for r in empty] == [("no rows", "0")]
    twice = checks.batch_contract(good.unionByName(good), ["msno", "y"]).collect()
    assert sorted(tuple(r) for r in twice) == [("duplicate ids", "2"), ("missing columns", "y")]
    for bad, required in ((good, ["msno", "y"]), (good.where("false"), ["msno"]), (good.unionByName(good), ["msno"])):
        with pytest.raises(ValueError):
            checks.enforce_contract(bad, required)


def test_levels_of_all_columns_are_fetched_once(spark, rows, monkeypatch):
    """One look at the stacked lookup, whatever the number of columns; the same rows if it is too large to fetch."""
    data = [(f"u{i}", "ab"[i % 2], None if i % 5 == 0 else "xyz"[i % 3], str(i % 4)) for i in range(60)]
    df = spark.createDataFrame(data, "msno string, p string, q string, r string")
    looks, fetch = [], lookup.bounded
    monkeypatch.setattr(lookup, "bounded", lambda *a: looks.append(1) or fetch(*a))
    small = prepare.group_rare_levels(df, ["p", "q", "r"], min_rows=14)
    assert len(looks) == 1
    monkeypatch.setattr(lookup, "bounded", lambda *a: None)
    assert rows(small) == rows(prepare.group_rare_levels(df, ["p", "q", "r"], min_rows=14))
    assert {r.q for r in small.collect()} == {"x", "y", "z", prepare.INFREQUENT_LEVEL}
    schema = prepare.category_schema(df.where("r <> '3'"), ["p", "q", "r"])
    assert {r.r for r in prepare.align_categories(df, schema, ["p", "q", "r"]).collect()} == {"0", "1", "2", None}
