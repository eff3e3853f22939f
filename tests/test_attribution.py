"""Contributions per row against enumeration over all subsets of features."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_boosting import frame

from stockweave.operators.attribution import attributed, contributions
from stockweave.operators.boosting import BoostParams, Run, Tree, binned, boost

#: Feature 0 is asked twice on one path.
TREE = Tree(
    feature=[0, 1, 0, -1, -1, -1, 2, -1, -1], cut=[3, 1, 6, 0, 0, 0, 2, 0, 0], left=[1, 3, 5, 0, 0, 0, 7, 0, 0],
    right=[2, 4, 6, 0, 0, 0, 8, 0, 0], value=[0, 0, 0, 1.0, -2.0, 4.0, 0, 8.0, 0.5], rows=[100, 40, 60, 10, 30, 25, 35, 15, 20],
    gain=[0.0] * 9,
)


def expected(tree, row, known, node=0):
    """Mean prediction where only some features are known: both sides by their rows where one is not."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    sides = tree.left[node], tree.right[node]
    if f in known:
        return expected(tree, row, known, sides[int(row[f] > tree.cut[node])])
    return sum(tree.rows[s] / tree.rows[node] * expected(tree, row, known, s) for s in sides)


def by_enumeration(tree, row, m):
    out = []
    for i in range(m):
        total = 0.0
        for k in range(m):
            for s in itertools.combinations([j for j in range(m) if j != i], k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                total += w * (expected(tree, row, {*s, i}) - expected(tree, row, set(s)))
        out.append(total)
    return [*out, expected(tree, row, set())]


def test_equal_to_enumeration():
    rows = np.array(list(itertools.product([0, 3, 4, 6, 9], [0, 1, 2], [1, 2, 3], [0])))
    got = contributions(rows.T, [TREE], 4, 0.0)
    for row, parts in zip(rows, got):
        assert np.allclose(parts, by_enumeration(TREE, row, 4))


def test_a_tree_without_splits_is_all_expectation():
    got = contributions(np.zeros((2, 3), np.uint8), [Tree(value=[7.0], rows=[5])], 2, 1.0)
    assert np.allclose(got, [[0, 0, 8]] * 3)


def test_contributions_sum_to_the_prediction(spark):
    x, _, df = frame(spark)
    model = boost(df, ["a", "b", "c"], "y", "place", [Run(500, 500)], BoostParams(leaves=9, rounds=5, step=0.3, min_leaf_rows=5))[0]
    rows = df.select("a", "b", "c", model.predict().alias("p"), attributed(model).alias("parts")).collect()
    assert all(sum(r["parts"]) == pytest.approx(r["p"]) for r in rows)
    mean = np.abs([r["parts"][:3] for r in rows]).mean(0)
    assert mean[0] > mean[1] > mean[2]
    odd = spark.createDataFrame([(None, 0.0, 1e9)], "a double, b double, c double")
    one = odd.select(model.predict().alias("p"), attributed(model).alias("parts")).first()
    assert sum(one["parts"]) == pytest.approx(one["p"])
    small = np.array([[r["a"], r["b"], r["c"]] for r in rows[:5]])
    bins = binned(list(small.T), model.edges)
    for k, r in enumerate(rows[:5]):
        want = np.sum([by_enumeration(t, bins[:, k], 3) for t in model.trees], 0)
        assert np.allclose(r["parts"][:3], want[:3])
    assert df.select(F.size(attributed(model))).first()[0] == 4
