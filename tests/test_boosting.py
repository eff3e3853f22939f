"""Leaf-wise boosted trees against a plain version over all rows at once."""

import heapq
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.operators import boosting
from stockweave.operators.boosting import BoostParams, Run, best_round, boost

EXACT = BoostParams(leaves=7, rounds=6, step=0.3, min_leaf_rows=5, patience=30, bins=16, kept_rounds=2, block_rows=64)


def plain_tree(bins, residual, p):
    """(splits in order, value per row): the leaf of largest gain first, all cuts of all features tried."""

    def best(rows):
        found = (0.0, None, None)
        g, n = residual[rows].sum(), len(rows)
        for f in range(bins.shape[1]):
            for cut in np.unique(bins[rows, f])[:-1]:
                left = rows[bins[rows, f] <= cut]
                if min(len(left), n - len(left)) < p.min_leaf_rows:
                    continue
                a = residual[left].sum()
                gain = a * a / len(left) + (g - a) ** 2 / (n - len(left)) - g * g / n
                if gain > found[0] + 1e-9:
                    found = (gain, f, int(cut))
        return found

    every = np.arange(len(bins))
    queue, leaves, splits, count = [(-best(every)[0], 0, every)], [], [], 1
    while queue:
        gain, order, rows = heapq.heappop(queue)
        _, f, cut = best(rows)
        if f is None or len(queue) + len(leaves) + 1 >= p.leaves:
            leaves.append(rows)
            continue
        splits.append((f, cut, len(rows)))
        for part in (rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]):
            count += 1
            heapq.heappush(queue, (-best(part)[0], count, part))
    value = np.zeros(len(bins))
    for rows in leaves:
        value[rows] = p.step * residual[rows].mean()
    return splits, value


def frame(spark, n=500, seed=1):
    rng = np.random.RandomState(seed)
    x = rng.randint(0, 12, (n, 3)).astype(float)
    y = 3 * x[:, 0] + np.where(x[:, 1] > 6, 10, 0) + rng.normal(0, 1, n)
    rows = [(int(i + 1), *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "place long, a double, b double, c double, y double")


def shape(tree, node=0):
    """A tree without the numbers of its nodes."""
    if tree.feature[node] < 0:
        return tree.value[node], tree.rows[node]
    return tree.feature[node], tree.cut[node], tree.gain[node], shape(tree, tree.left[node]), shape(tree, tree.right[node])


def test_trees_equal_plain_version(spark):
    x, y, df = frame(spark)
    runs = [Run(300, 350), Run(450, 500)]
    models = boost(df.repartition(5), ["a", "b", "c"], "y", "place", runs, EXACT)
    for run, model in zip(runs, models):
        bins = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(model.edges)], 1)[: run.train_to]
        score = np.full(run.train_to, y[: run.train_to].mean())
        assert model.base == pytest.approx(score[0])
        for tree in model.trees:
            splits, value = plain_tree(bins, y[: run.train_to] - score, EXACT)
            got = [(f, c, n) for f, c, n in zip(tree.feature, tree.cut, tree.rows) if f >= 0]
            assert sorted(got) == sorted(splits)
            assert np.allclose(boosting.scores_of(bins.T, [tree]), value, atol=1e-6)
            score += value
        valid = slice(run.train_to, run.valid_to)
        cut = np.stack([np.searchsorted(e, x[valid, i]) for i, e in enumerate(model.edges)])
        all_errors = [np.mean((y[valid] - model.base - boosting.scores_of(cut, model.trees[: k + 1])) ** 2)
                      for k in range(len(model.trees))]
        assert np.allclose(model.errors[: len(all_errors)], all_errors, atol=1e-6)


def test_partitions_and_kept_scores_change_nothing(spark):
    _, _, df = frame(spark)
    runs = [Run(400, 500)]  # local and merged leaves, in any mixture
    one = boost(df.coalesce(1), ["a", "b", "c"], "y", "place", runs, EXACT)[0]
    for local in (0, 150):
        p = replace(EXACT, kept_rounds=1, block_rows=7, rows_per_task=60, local_rows=local)
        got = boost(df.repartition(9), ["a", "b", "c"], "y", "place", runs, p)[0]
        assert [shape(t) for t in got.trees] == [shape(t) for t in one.trees]
        assert got.errors == one.errors


def test_leaves_and_rows_are_bounded(spark):
    _, _, df = frame(spark, 800)
    p = BoostParams(leaves=63, rounds=2, step=1.0, min_leaf_rows=20)
    model = boost(df, ["a", "b", "c"], "y", "place", [Run(800, 800)], p)[0]
    for tree in model.trees:
        ends = [n for f, n in zip(tree.feature, tree.rows) if f < 0]
        assert 1 < len(ends) <= 63 and min(ends) >= 20 and sum(ends) == 800


def test_a_leaf_chain_is_found(spark):
    """Deeper than any level-wise tree of as many leaves: one side is split again and again."""
    rows = [(i + 1, float(i % 9), 4.0 ** (i % 9)) for i in range(180)]
    df = spark.createDataFrame(rows, "place long, a double, y double")
    p = BoostParams(leaves=9, rounds=1, step=1.0, min_leaf_rows=1, bins=64)
    tree = boost(df, ["a"], "y", "place", [Run(180, 180)], p)[0].trees[0]
    depth = {0: 0}
    for node, f in enumerate(tree.feature):
        if f >= 0:
            depth[tree.left[node]] = depth[tree.right[node]] = depth[node] + 1
    assert sum(f < 0 for f in tree.feature) == 9 and max(depth.values()) == 8


def test_rounds_stop_under_patience(spark):
    assert best_round([5, 4, 3, 3, 3], 2) == 3
    assert best_round([5, 4, 6, 6, 1], 2) == 2 and best_round([5, 4, 6, 6, 1], 4) == 5
    rng = random.Random(3)
    data = [(i + 1, float(rng.randrange(6)), rng.gauss(0, 2)) for i in range(300)]
    df = spark.createDataFrame([(i, x, 3 * x + e) for i, x, e in data], "place long, x double, y double")
    p = BoostParams(rounds=60, patience=5, step=0.5, leaves=4, min_leaf_rows=1)
    early, late = boost(df, ["x"], "y", "place", [Run(200, 300), Run(280, 280)], p)
    assert 1 < len(early.trees) < 60 and len(early.errors) < 60
    assert len(late.trees) <= 60 and not late.errors


def test_nothing_to_split_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(1, 50)] + [(50, 1.0, None)], "place long, x double, y double")
    model = boost(df, ["x"], "y", "place", [Run(50, 50)], EXACT)[0]
    assert model.trees == () and df.select(model.predict().alias("p")).distinct().collect() == [(2.0,)]
    with pytest.raises(ValueError):
        boost(df, ["x"], "y", "place", [Run(0, 10)], EXACT)


def test_prediction_of_nulls_and_unseen_values(spark):
    _, _, df = frame(spark)
    model = boost(df, ["a", "b", "c"], "y", "place", [Run(500, 500)], EXACT)[0]
    odd = spark.createDataFrame([(None, 0.0, 0.0), (0.0, 0.0, 0.0), (1e9, 0.0, 0.0), (11.0, 0.0, 0.0)], "a double, b double, c double")
    got = [r[0] for r in odd.select(model.predict()).collect()]
    assert got[0] == got[1] and got[2] == got[3]
    assert sum(model.gains()) == pytest.approx(1) and model.gains()[0] > model.gains()[2]
    assert df.select(F.avg(F.abs(model.predict() - F.col("y")))).first()[0] < 4
