"""The forest on cells: splits against brute force, bootstrap, partitioning."""

import random

import numpy as np
import pytest

from ledgerlens.operators import boosting as B
from ledgerlens.operators import forest
from ledgerlens.operators import model as M


def _rows(n=600, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.randint(0, 9), r.random(), r.choice([None, float("nan"), 0.5, 1.5])
        out.append((i, float(a), b, c, int((a > 4) != (b > 0.5))))
    return out


KIND = "id int, a double, b double, c double, y int"


def test_forest_is_the_same_for_every_partitioning(spark):
    df = spark.createDataFrame(_rows(), KIND)
    got = [{r["id"]: r["score"] for r in M.fit_predict(df.repartition(n), ["a", "b", "c"], "y", "forest", ["id"], numTrees=12).collect()}
           for n in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == 600
    y = {r[0]: r[4] for r in _rows()}
    assert np.mean([(s > 0.5) == (y[i] == 1) for i, s in got[0].items()]) > 0.9


def test_forest_of_several_blocks_is_whole(spark):
    """Blocks of cells meet by tree: without a bootstrap, many blocks make the trees of one."""
    df = spark.createDataFrame(_rows(), KIND)
    sampled, forest._sampled = forest._sampled, lambda n, x, seed, tree: n.astype(float)
    try:
        grown = [forest.fit(df, ["a", "b", "c"], "y", (1.0, 2.0), trees=3, depth=5, block_cells=cells) for cells in (1 << 18, 60)]
    finally:
        forest._sampled = sampled
    for s, t in zip(grown[0].trees, grown[1].trees):
        assert s.feature.tolist() == t.feature.tolist() and s.cut.tolist() == t.cut.tolist() and s.value == pytest.approx(t.value)
    assert max(len(t.feature) for t in grown[0].trees) > 7


def test_forest_split_is_the_largest_fall_of_impurity():
    r = np.random.default_rng(1)
    x, rows = r.integers(0, 6, (40, 2)).astype(np.uint8), r.integers(0, 9, (40, 2)).astype(float)
    columns, w = np.array([[0, 1]]), (1.0, 3.0)
    (total, gain, column, cut, left, right), = forest.best_splits(forest._node_sums(x, rows, np.zeros(40, int), 1, [0], columns, 6), columns, w)

    def gini(m):
        a, b = (rows[m] * w).sum(0)
        return 2 * a * b / (a + b) if a + b else 0.0
    best = max(gini(x[:, 0] >= 0) - gini(x[:, c] <= k) - gini(x[:, c] > k) for c in (0, 1) for k in range(5))
    assert gain == pytest.approx(best) == pytest.approx(gini(x[:, 0] >= 0) - gini(x[:, column] <= cut) - gini(x[:, column] > cut))
    assert total == pytest.approx(np.add(left, right)) and total == pytest.approx((rows * w).sum(0))


def test_forest_samples_rows_not_cells():
    """The n rows of a cell are drawn as n rows are: mean and variance n."""
    n, x = np.array([[400, 0], [0, 9]]), np.zeros((2, 3), np.uint8)
    s = np.array([forest._sampled(n, x, 42, t) for t in range(2000)])
    assert s[:, 0, 0].mean() == pytest.approx(400, rel=0.01) and s[:, 0, 0].var() == pytest.approx(400, rel=0.15)
    assert s[:, 1, 1].var() == pytest.approx(9, rel=0.15) and s[:, 0, 1].max() == s[:, 1, 0].max() == 0
    assert (forest._sampled(n, x, 42, 7) == s[7]).all()


def test_forest_without_rows_and_of_one_class(spark):
    df = spark.createDataFrame(_rows(), KIND)
    assert M.fit_predict(df.limit(0), ["a", "b", "c"], "y", "forest", ["id"], numTrees=2).count() == 0
    ones = M.fit_predict(df.filter("y = 1"), ["a", "b", "c"], "y", "forest", ["id"], numTrees=2)
    assert {r["score"] for r in ones.collect()} == {1.0}
    with pytest.raises(ValueError):
        M.fit_predict(df.replace(1, 2, ["y"]), ["a", "b", "c"], "y", "forest", ["id"], numTrees=2)


def test_forest_leaves_of_one_parent_and_class_are_one():
    t = forest._Tree()
    kids = t.split(0, ((5.0, 5.0), 1.0, 0, 3, (4.0, 1.0), (1.0, 4.0)))
    t.split(kids[0], ((4.0, 1.0), 0.1, 1, 2, (3.0, 0.0), (1.0, 0.9)))
    t.prune()
    a = t.arrays()
    assert (a.feature >= 0).tolist() == [True, False, False, False, False] and a.value[kids[0]] == pytest.approx(0.2)
    assert isinstance(a, B.Tree)
