import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import lookup, metrics, prepare, queue, rank


def scored(spark, pairs, parts=5):
    df = spark.createDataFrame([(f"id{i:05d}", s) for i, s in pairs], "msno string, risk_score double")
    return df.repartition(parts)


def expected_ranks(pairs):
    order = sorted(pairs, key=lambda p: (-p[1], p[0]))
    return {f"id{i:05d}": n for n, (i, _) in enumerate(order, start=1)}


@pytest.mark.parametrize("kind", ["distinct", "tied", "one value", "third tied"])
@pytest.mark.parametrize("parts", [1, 7])
def test_ranks_match_a_sort(spark, kind, parts):
    noise = random.Random(3)
    value = {
        "distinct": lambda i: noise.random(),
        "tied": lambda i: noise.randint(0, 4) / 4,
        "one value": lambda i: 0.5,
        "third tied": lambda i: 0.9 if i % 3 == 0 else noise.random(),
    }[kind]
    pairs = [(i, value(i)) for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = queue.risk_rank(scored(spark, pairs, parts)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.msno: r.risk_rank for r in found} == expected_ranks(pairs)
    assert {r.ranked_customers for r in found} == {500}


@pytest.mark.parametrize("n, deciles", [
    (1, [1]), (9, [1, 2, 3, 4, 5, 6, 7, 8, 9]),
    (15, [1, 1, 2, 3, 3, 4, 5, 5, 6, 7, 7, 8, 9, 9, 10]),
])
def test_decile_rule(spark, n, deciles):
    found = queue.risk_rank(scored(spark, [(i, 1.0 - i / 100) for i in range(n)]))
    assert [r.risk_decile for r in found.orderBy("risk_rank").collect()] == deciles


def test_a_tied_block_is_spread_over_parts(spark):
    """Equal scores are cut by id, so no task gets the whole block."""
    df = scored(spark, [(i, 0.5) for i in range(4000)], 4)
    laid, keys = rank._laid_out(df, [rank.falling(F.col("risk_score")), F.col("msno")], [])
    sizes = [r["count"] for r in laid.groupBy(*keys).count().collect()]
    assert len(sizes) >= 20 and max(sizes) < 4000 / 10


def test_cuts_do_not_depend_on_partitioning(spark, rows, monkeypatch):
    """Parts are the same for every layout of the input, also when only some of the keys are sampled."""
    monkeypatch.setattr(rank, "KEYS_PER_PART", 3)
    order = [rank.falling(F.col("risk_score")), F.col("msno")]
    found = [
        rows(rank._laid_out(scored(spark, [(i, (i * 7919 % 613) / 613) for i in range(3000)], parts), order, [])[0])
        for parts in (1, 6)
    ]
    assert found[0] == found[1]
    parts = [p for *_, p in sorted(found[0], key=lambda r: (-r[1], r[0]))]
    assert parts == sorted(parts) and len(set(parts)) > 20


@pytest.mark.parametrize("sampled", [1, 20])
def test_ranks_of_groups_match_a_sort(spark, monkeypatch, sampled):
    """Groups of very different sizes, without names and with missing scores, over several parts each."""
    monkeypatch.setattr(rank, "KEYS_PER_PART", sampled)
    noise = random.Random(8)
    data = [(f"id{i:05d}", noise.choice([None, float("nan"), 0.0, -0.0, 0.5, noise.random()]), noise.choice(["a"] * 30 + ["b", None])) for i in range(1500)]
    df = spark.createDataFrame(data, "msno string, risk_score double, g string").repartition(5)
    found = {r.msno: (r.risk_rank, r.ranked_customers) for r in queue.risk_rank(df, by=["g"]).collect()}
    expected = {}
    for g in ("a", "b", None):
        own = [(s is None or s != s, -(s or 0.0) if s == s else 0.0, i) for i, s, h in data if h == g]
        expected |= {i: (n, len(own)) for n, (_, _, i) in enumerate(sorted(own), 1)}
    assert found == expected


def test_groups_and_missing_group(spark):
    rows = [("a", 1.0, "x"), ("b", 2.0, "x"), ("c", 1.0, None), ("d", 3.0, None), ("e", 0.0, "y")]
    df = spark.createDataFrame(rows, "msno string, risk_score double, g string")
    found = queue.risk_rank(df, by=["g"]).collect()
    assert {r.msno: (r.risk_rank, r.ranked_customers) for r in found} == {
        "a": (2, 2), "b": (1, 2), "c": (2, 2), "d": (1, 2), "e": (1, 1),
    }


def test_running_totals(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"), (F.col("id") % 2).alias("g"))
    found = rank.running_totals(df.repartition(6), [rank.falling(F.col("k"))], ["v"], ["g"]).collect()
    for g in (0, 1):
        total = 0
        for r in sorted((r for r in found if r.g == g), key=lambda r: -r.k):
            total += r.v
            assert r.cum_v == total
        assert {r.total_v for r in found if r.g == g} == {total}


def test_quantiles_match_numpy(spark):
    noise = np.random.default_rng(5)
    values = [float(v) for v in noise.integers(0, 40, 199)] + [None, float("nan")]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "a double, b double")
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    found = {(r.column, r.probability): r.value for r in rank.exact_quantiles(df, ["a", "b"], probabilities).collect()}
    clean = [v for v in values if v is not None and v == v]
    for p in probabilities:
        assert found["a", p] == pytest.approx(np.quantile(clean, p))
        assert found["b", p] == pytest.approx(np.quantile(range(201), p))


def test_lookup_beyond_the_broadcast_limit_gives_the_same_rows(spark, rows):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    df = df.withColumn("k", F.when(F.col("id") != 7, F.col("k")))
    table = df.groupBy("k").agg(F.count("*").alias("n")).where("k is null or k != '11'")
    small = lookup.attach(df, table, ["k"])
    salted = lookup.attach(df, table, ["k"], max_rows=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small) == rows(salted)
    assert salted.count() == 2000 and salted.where("n is null").count() == 1


def test_ranks_write_no_files(spark):
    """Neither building nor reading a rank, a lift table or a threshold stores a copy of the rows."""
    folder = spark.sparkContext.getCheckpointDir()

    def files():
        return {p for p in Path(folder.removeprefix("file:")).rglob("part-*")} if folder else set()

    before = files()
    df = scored(spark, [(i, (i % 17) / 17) for i in range(500)]).withColumn("is_churn", F.lit(1))
    for out in (queue.risk_rank(df), metrics.lift_table(df), metrics.topk_threshold(df), metrics.average_precision(df)):
        assert out.count() > 0
    assert spark.sparkContext.getCheckpointDir() == folder and files() == before


def test_ranks_need_no_single_task_window(spark):
    """Rows meet in windows over parts only; an unpartitioned window sees one row per part."""
    out = queue.risk_rank(scored(spark, [(i, 0.5) for i in range(50)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    numbered = [line for line in windows if "row_number" in line]
    assert len(numbered) == 1 and "[_part#" in numbered[0]
    assert all("_s_n" in line for line in windows if line not in numbered)


def test_totals_by_value(spark, monkeypatch):
    monkeypatch.setattr(rank, "KEYS_PER_PART", 2)
    noise = random.Random(2)
    data = [(noise.choice("xy"), noise.choice([None, *range(300)]), noise.randint(0, 5)) for _ in range(4000)]
    df = spark.createDataFrame(data, "g string, v long, n long").repartition(6)
    for falling in (False, True):
        found = rank.totals_by_value(df, F.col("v"), "value", {"n": F.col("n")}, ["g"], falling).collect()
        for g in "xy":
            sums = {}
            for h, v, n in data:
                if h == g:
                    sums[v] = sums.get(v, 0) + n
            order = sorted((v for v in sums if v is not None), reverse=falling)
            order = order + [None] * (None in sums) if falling else [None] * (None in sums) + order
            cum = np.cumsum([sums[v] for v in order]).tolist()
            own = {r.value: (r.n, r.cum_n, r.total_n) for r in found if r.g == g}
            assert own == {v: (sums[v], c, cum[-1]) for v, c in zip(order, cum)}


@pytest.mark.parametrize("kind", ["distinct", "tied", "two values", "skewed", "infinite"])
def test_quantiles_by_narrow_brackets(spark, monkeypatch, kind):
    """Several scans narrow each bracket, and the plan orders only what lies within."""
    monkeypatch.setattr(rank, "BRACKET_ROWS", 40)
    noise = np.random.default_rng(7)
    values = {
        "distinct": noise.normal(size=20_000), "tied": noise.integers(0, 50, 20_000) / 7, "two values": np.repeat([1.0, 2.0], [9_999, 10_001]),
        "skewed": np.exp(noise.normal(size=20_000) * 6), "infinite": np.concatenate([[np.inf] * 50, [-np.inf] * 50, noise.normal(size=9_000)]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values], "a double").repartition(7)
    probabilities = [0.0, 0.001, 0.25, 0.4999, 0.5, 0.99, 1.0]
    out = rank.exact_quantiles(df, ["a"], probabilities)
    found = {r.probability: r.value for r in out.collect()}
    ordered = np.sort(values)
    for p in probabilities:
        h = (len(values) - 1) * p
        low, high = ordered[int(np.floor(h))], ordered[int(np.ceil(h))]
        assert found[p] == pytest.approx(low if low == high else low + (high - low) * (h - np.floor(h)))


def test_quantiles_of_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), None)], "a double, b double")
    assert [tuple(r) for r in rank.exact_quantiles(df, ["a", "b"], [0.5]).collect()] == [("b", 0.5, 1.0)]
    assert rank.exact_quantiles(df.limit(0), ["a"], [0.5]).collect() == []


@pytest.mark.parametrize("n", [1, 2, 10, 97])
def test_split_sizes_and_shares(spark, n):
    df = spark.createDataFrame([(f"c{i}", int(i % 4 == 0)) for i in range(n)], "msno string, is_churn int")
    split = prepare.stratified_split(df)
    test = split.where("split = 'test'")
    assert split.count() == n and test.count() == -(-n // 5)
    expected = sum(1 for i in range(n) if i % 4 == 0) / 5
    assert abs(test.where("is_churn = 1").count() - expected) <= 1


def test_split_does_not_depend_on_partitioning(spark, rows):
    df = spark.createDataFrame([(f"c{i}", int(i % 5 == 0)) for i in range(200)], "msno string, is_churn int")
    assert rows(prepare.stratified_split(df.repartition(1))) == rows(prepare.stratified_split(df.repartition(9)))
    assert rows(prepare.stratified_split(df, seed=1)) != rows(prepare.stratified_split(df, seed=2))


def test_sample_is_capped_at_the_rows_there_are(spark):
    df = spark.createDataFrame([(f"c{i}", i % 2) for i in range(30)], "msno string, is_churn int")
    per_class = prepare.stratified_sample(df, 10).groupBy("is_churn").count()
    assert sorted(tuple(r) for r in per_class.collect()) == [(0, 5), (1, 5)]
    assert prepare.stratified_sample(df, 1000).count() == 30


@pytest.mark.parametrize("digits, most", [(1, 1), (1, 10), (2, 3), (3, 100_000)])
def test_radix_selection_equals_an_order(spark, monkeypatch, digits, most):
    """The members are the first of each class by hash and id, whatever the number of scans that find them."""
    monkeypatch.setattr(prepare, "RADIX_DIGITS", digits)
    monkeypatch.setattr(prepare, "RADIX_ROWS", most)
    data = [(f"c{i}", [0, 0, 0, 0, 1, 1, None][i % 7]) for i in range(400)] + [("lone", 9)]
    df = spark.createDataFrame(data, "msno string, is_churn int").repartition(4)
    split = {r.msno: r.split for r in prepare.stratified_split(df, seed=7).collect()}
    sample = {r.msno for r in prepare.stratified_sample(df, 57, seed=7).collect()}
    assert len(split) == 401 and len(sample) == 57
    for chosen in ({i for i, part in split.items() if part == "train"}, sample):
        for c in (0, 1, None, 9):
            order = sorted((i for i, k in data if k == c), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
            own = [i for i in order if i in chosen]
            assert own == order[: len(own)]


def test_selection_moves_no_row(spark):
    plan = prepare.stratified_split(spark.range(100).select(F.col("id").cast("string").alias("msno"), (F.col("id") % 2).alias("is_churn")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "Window" not in text and "Sort" not in text
