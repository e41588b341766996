"""Boosted trees against exhaustive search, their invariants, and what missing values and levels teach them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import metrics, models, trees
from ebbtide.operators.trees import Bins, BoostedTrees, Grower, Tree, fit_trees

SCHEMA = "label int, weight double, is_validation boolean, a double, b double, k string"


def planted(n=1500, seed=0):
    """The chance depends on a missing number, on two numbers together and on a set of levels without order."""
    rng = np.random.default_rng(seed)
    a, b, k, gone = rng.normal(size=n), rng.integers(0, 9, n).astype(float), rng.integers(0, 10, n), rng.random(n) < 0.3
    logit = 2.5 * (a > 0.3) * (b < 4) + 2 * np.isin(k, [1, 4, 8]) + 2.5 * gone - 2.5
    y = rng.random(n) < 1 / (1 + np.exp(-logit))
    return [
        (int(y[i]), 1.0 + (i % 3), i % 10 == 0, None if gone[i] and i % 2 else float("nan") if gone[i] else float(a[i]), float(b[i]), None if i % 97 == 0 else f"l{k[i]}")
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(planted(), SCHEMA)
    return df, fit_trees(df, ["a", "b"], ["k"], max_iter=12, min_leaf=15, leaves=8)


def auc(model, df):
    return metrics.roc_auc(model.probability(df, "p"), "label", "p").first()[0]


def test_signals_are_found(spark, fitted):
    df, model = fitted
    fresh = spark.createDataFrame(planted(seed=5), SCHEMA)
    assert auc(model, fresh) > 0.8
    # without the branch for missing values, these rows are like any others
    assert auc(model, fresh) > auc(model, fresh.withColumn("a", F.coalesce(F.nanvl("a", F.lit(0.0)), F.lit(0.0)))) + 0.05
    assert model.losses[-1] < model.losses[0]


def test_limits_hold(fitted):
    df, model = fitted
    rows = [r for r in df.where("not is_validation").collect()]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], pa.string() if c == "k" else pa.float64()) for c in "abk"})
    codes = model.bins.codes(batch)
    for tree in model.trees:
        leaves, sizes = np.unique(tree.nodes(codes), return_counts=True)
        assert len(leaves) <= 8 and sizes.min() >= 15
        assert all(c > i for i, made in enumerate(tree.children) for c in made if c >= 0)


@pytest.mark.parametrize("parts", [2, 7])
def test_trees_do_not_depend_on_partitioning(spark, fitted, monkeypatch, parts):
    df, model = fitted
    monkeypatch.setattr(trees, "ROWS_PER_PART", 1500 // parts)
    monkeypatch.setattr(trees, "TREES_PER_STEP", 2)
    again = fit_trees(df.repartition(parts), ["a", "b"], ["k"], max_iter=5, min_leaf=15, leaves=8)
    assert again.trees == model.trees[:5] and again.losses == model.losses[:5]


def brute_split(histogram, sizes, numeric, l2, min_leaf):
    """The best gain over every cut, either side for missing values, and every prefix of levels by gradient."""
    total = histogram[0].sum(axis=0).astype(float)
    score = lambda s: s[0] ** 2 / (s[1] + l2 * trees.UNIT) / trees.UNIT
    best = 0.0
    for f, size in enumerate(sizes):
        cells, missing = histogram[f, :size].astype(float), histogram[f, size].astype(float)
        order = list(range(size)) if f < numeric else sorted((c for c in range(size) if cells[c, 2]), key=lambda c: cells[c, 0] / (cells[c, 1] + trees.LEVEL_SMOOTHING * trees.UNIT))
        for cut in range(1, len(order) + 1):
            for side in (0, 1):
                left = cells[order[:cut]].sum(axis=0) + side * missing
                right = total - left
                if min(left[2], right[2]) >= min_leaf:
                    best = max(best, score(left) + score(right) - score(total))
    return best


@pytest.mark.parametrize("seed", range(8))
def test_a_split_is_the_best_there_is(seed):
    rng = np.random.default_rng(seed)
    sizes, n = [6, 9, 5], 400
    histogram = np.zeros((3, 10, 3), dtype=np.int64)
    codes = [rng.integers(0, s + (seed % 2), n) for s in sizes]
    g, h = rng.normal(size=n), rng.random(n) * 0.25
    for f, own in enumerate(codes):
        for values, j in ((g, 0), (h, 1), (np.full(n, 1 / trees.UNIT), 2)):
            np.add.at(histogram[f, :, j], own, np.rint(values * trees.UNIT).astype(np.int64))
    for f in (1, 2):  # rounded sums of one node agree over its features
        histogram[f, 0, :2] += histogram[0, :, :2].sum(axis=0) - histogram[f, :, :2].sum(axis=0)
    grower = Grower(sizes, 2, 1.0, 20, 8, 0.1)
    grower.put(0, histogram)
    found = grower.best[0]
    assert found.gain == pytest.approx(brute_split(histogram, sizes, 2, 1.0, 20))
    left = sum((histogram[found.feature, c] for c in range(sizes[found.feature] + 1) if found.left[c]), np.zeros(3, dtype=np.int64))
    assert left.tolist() == found.sums[0].tolist() and (found.sums[0] + found.sums[1]).tolist() == histogram[0].sum(axis=0).tolist()


def test_best_first_growth_keeps_the_dearest_splits():
    """With room for one more leaf than the root's two, the side with the larger gain is split."""
    codes = np.array([[c] for c in range(4) for _ in range(50)])
    g = np.repeat([-4.0, 4.0, 0.5, 1.0], 50)
    histogram = np.zeros((1, 5, 3), dtype=np.int64)
    for c in range(4):
        histogram[0, c] = [int(g[codes[:, 0] == c].sum() * trees.UNIT), 50 * trees.UNIT, 50]
    grower = Grower([4], 1, 1.0, 10, 3, 1.0)
    grower.put(0, histogram)
    kept, open_ = grower.grown()
    while open_:
        counted = {i: np.where((grower.tree.nodes(np.arange(5)[:, None]) == i)[None, :, None], histogram, 0) for i in grower.wanted(open_)}
        grower.fill(counted, open_)
        kept, open_ = grower.grown()
    tree = grower.pruned(kept)
    assert len(tree.feature) == 5
    leaf = tree.nodes(np.arange(4)[:, None])
    assert leaf[0] != leaf[1] and leaf[2] == leaf[3]


def test_stored_trees_are_the_same(spark, fitted):
    df, model = fitted
    again = BoostedTrees.of_rows(model.rows(spark))
    assert (again.bins.cuts, again.bins.levels, again.base, again.trees) == (dict(model.bins.cuts), dict(model.bins.levels), model.base, model.trees)


def test_training_stops_when_validation_gets_no_better(spark):
    noise = np.random.default_rng(3)
    rows = [(int(noise.random() < 0.5), 1.0, i % 4 == 0, float(noise.normal()), 0.0, "x") for i in range(600)]
    model = fit_trees(spark.createDataFrame(rows, SCHEMA), ["a", "b"], ["k"], step=0.5, max_iter=40, min_leaf=5, patience=3)
    assert len(model.losses) < 40 and min(model.losses[-3:]) >= min(model.losses[:-3]) - 1e-7


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(1, 1.0, False, None, None, None)] * 30, SCHEMA)
    for df in (empty, one):
        model = fit_trees(df, ["a", "b"], ["k"], max_iter=3, min_leaf=5)
        assert model.trees == []
        assert all(0 <= r.p <= 1 for r in model.probability(one, "p").collect())
    assert Bins({"a": []}, {}).sizes() == [1] and Tree()(np.zeros((2, 1), dtype=np.uint16)).tolist() == [0.0, 0.0]


def test_only_histograms_reach_the_driver(fitted, monkeypatch):
    """Whatever the rows, a pass returns at most one row per node, feature and code."""
    from pyspark.sql.classic.dataframe import DataFrame

    df, _ = fitted
    sizes, fetch = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: (found := fetch(self), sizes.append((found.num_rows, found.column_names)))[0])
    fit_trees(df.union(df).union(df), ["b"], ["k"], max_iter=1, min_leaf=15, leaves=4)
    passes = [n for n, names in sizes if names[:1] == ["node"]]
    assert passes and max(passes) <= 2 * 2 * 11 + 1


def test_importance_by_counts_equals_importance_by_rows(spark):
    """Swapping within a task gives what scoring a table of all swapped rows gives."""
    rows = [(f"u{i}", r[0], *r[3:]) for i, r in enumerate(planted(600))]
    df = spark.createDataFrame(rows, "msno string, is_churn int, a double, b double, k string").repartition(3)
    model = models.fit_boosted(df, ["a", "b"], ["k"], max_iter=4, min_leaf=15)

    class Plain:
        score = staticmethod(model.score)

    found, expected = ({r.feature: (r[1], r[2]) for r in models.permutation_importance(m, df, ["a", "b", "k"], repeats=2).collect()} for m in (model, Plain))
    assert found.keys() == expected.keys() == {"a", "b", "k"}
    for f in found:
        assert found[f] == pytest.approx(expected[f], abs=1e-12)
    assert max(found, key=lambda f: found[f][0]) in "ak"


def test_rows_are_dealt_to_all_cores(spark, monkeypatch):
    """A table far below half a million rows is shared by the cores, and a block holds bounded bytes."""
    paths, fresh = [], trees.scratch_path
    monkeypatch.setattr(trees, "scratch_path", lambda *a: (paths.append(fresh(*a)), paths[-1])[1])
    monkeypatch.setattr(trees, "BLOCK_BYTES", 6 * 4000)
    df = spark.range(100_000).selectExpr("cast(id % 3 = 0 as int) label", "1d weight", "id % 10 = 0 is_validation", "cast(id % 50 as double) a", "cast(id % 7 as double) b", "'x' k")
    fit_trees(df, ["a", "b"], ["k"], max_iter=1, leaves=2)
    blocks = spark.read.parquet(paths[0]).select(F.input_file_name().alias("file"), (F.length("codes") / 6).alias("n")).collect()
    assert len({r.file for r in blocks}) >= 5
    assert sum(r.n for r in blocks) == 100_000 and max(r.n for r in blocks) <= 4000


def test_parts_grow_with_rows():
    assert trees._parts(0, 22, 12) == trees._parts(15_000, 22, 12) == 1
    assert trees._parts(700_000, 22, 12) == 12
    assert trees._parts(10**9, 22, 12) >= 10**9 * 44 // (trees.BLOCK_BYTES * trees.BLOCKS_PER_PART)


@pytest.mark.parametrize("seed", range(3))
def test_leaves_are_those_of_a_walk_from_the_root(seed):
    rng = np.random.default_rng(seed)
    codes, tree, leaves = rng.integers(0, 5, (300, 3)).astype(np.uint16), Tree(), [0]
    for _ in range(9):
        node = leaves.pop(int(rng.integers(len(leaves))))
        leaves += tree.split(node, int(rng.integers(3)), (rng.random(5) < 0.5).tolist(), (rng.random(), rng.random()))

    def walked(row, node=0):
        return node if tree.feature[node] < 0 else walked(row, tree.children[node][0 if tree.lefts[node][row[tree.feature[node]]] else 1])

    assert tree.nodes(codes).tolist() == tree.nodes(np.asfortranarray(codes)).tolist() == [walked(row) for row in codes]
