"""Swaps of single features: against walks from the root, against scoring every swapped row, and what they pass on."""

import numpy as np
import pytest

from ebbtide.operators import models, swaps
from ebbtide.operators.trees import Tree
from tests.test_trees import planted


def frame(spark, n=600, spoilt=False):
    rows = [(f"u{i}", None if spoilt and i % 11 == 0 else r[0], *r[3:]) for i, r in enumerate(planted(n))]
    return spark.createDataFrame(rows, "msno string, is_churn int, a double, b double, k string").repartition(3)


@pytest.fixture(scope="module")
def fitted(spark):
    df = frame(spark)
    return df, models.fit_boosted(df, ["a", "b"], ["k"], max_iter=4, min_leaf=15)


def importance(model, df, repeats=2):
    return {r.feature: (r[1], r[2]) for r in models.permutation_importance(model, df, ["a", "b", "k"], repeats=repeats).collect()}


def plain(model):
    class Plain:
        score = staticmethod(model.score)

    return Plain


@pytest.mark.parametrize("seed", range(4))
def test_swaps_are_walks_from_the_root(seed):
    rng = np.random.default_rng(seed)
    own, other, trees = *rng.integers(0, 5, (2, 3, 200)).astype(np.uint16), []
    for size in (0, 3, 9, 14):
        tree, leaves = Tree(values=[float(rng.random())]), [0]
        for _ in range(size):  # three features only, so paths meet them again
            leaves += tree.split(leaves.pop(int(rng.integers(len(leaves)))), int(rng.integers(3)), (rng.random(5) < 0.5).tolist(), tuple(rng.random(2)))
        trees.append(tree)

    def walked(tree, row, node=0):
        return tree.values[node] if tree.feature[node] < 0 else walked(tree, row, tree.children[node][0 if tree.lefts[node][row[tree.feature[node]]] else 1])

    def summed(codes):
        out = np.zeros(codes.shape[1])
        for tree in trees:
            out += [walked(tree, row) for row in codes.T]
        return out.tolist()

    sums, swapped = swaps.swapper(trees)(own, other)
    assert sums.tolist() == summed(own)
    for f in range(3):
        mixed = own.copy()
        mixed[f] = other[f]
        assert swapped[f].tolist() == summed(mixed)


def test_only_scores_that_change_are_passed_on(spark, fitted, monkeypatch):
    """A table of a row per feature, repeat and score is never stored."""
    from pyspark.sql.classic.dataframe import DataFrame

    df, model = fitted
    stored, keep = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, eager=True: (out := keep(self, eager), stored.append((out.columns, out.count())))[0])
    importance(model, df)
    assert stored and max(n for _, n in stored) <= df.count(), stored


@pytest.mark.parametrize("spoilt", [False, True])
def test_many_parts_and_missing_labels(spark, fitted, monkeypatch, spoilt):
    _, model = fitted
    df = frame(spark, spoilt=spoilt)
    expected = importance(plain(model), df)
    monkeypatch.setattr(swaps, "COUNTS_PER_PART", 300)
    monkeypatch.setattr(swaps, "COUNTS_PER_PACK", 100)
    found = importance(model, df)
    assert found.keys() == expected.keys() == {"a", "b", "k"}
    for f in found:
        assert found[f] == pytest.approx(expected[f], abs=1e-12)


def test_no_rows_no_positives_no_trees(spark, fitted):
    df, model = fitted
    assert importance(model, df.limit(0)) == {}
    assert set(importance(model, df.where("is_churn = 0")).values()) == {(None, None)}
    bare = models.TreeModel(model.numeric, model.categories, models.BoostedTrees(model.trees.bins, 0.1, [], []))
    assert set(importance(bare, df).values()) == {(0.0, 0.0)}
