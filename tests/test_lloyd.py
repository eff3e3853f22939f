"""Batched K-Means against a plain version from the same seeds."""

import numpy as np
import pytest

from stockweave.operators import lloyd
from stockweave.session import materialize

FEATURES = ["a", "b", "c"]


def points(spark, n=600, seed=2):
    rng = np.random.RandomState(seed)
    x = rng.normal(0, 1, (n, 3)) + rng.randint(0, 5, (n, 1)) * np.array([6.0, 2.0, 0.5])
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")


def plain_lloyd(x, centers, rounds=200, tol=1e-4):
    for _ in range(rounds):
        gaps = ((x[:, None] - centers[None]) ** 2).sum(2)
        near = gaps.argmin(1)
        after = np.array([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centers)])
        if ((after - centers) ** 2).sum() <= tol * x.var(0).mean():
            centers = after
            break
        centers = after
    gaps = ((x[:, None] - centers[None]) ** 2).sum(2)
    return centers, gaps.min(1).sum(), gaps.argmin(1)


def test_runs_equal_plain_lloyd(spark):
    x, df = points(spark)
    runs = [2, 5, 5, 3]
    blocks = materialize(lloyd.point_blocks(df.repartition(4), FEATURES, "id", 70), "blocks")
    seeds = lloyd.seed_centers(blocks, 3, runs, 42)
    known = {tuple(r) for r in x}
    assert [len({tuple(c) for c in s}) for s in seeds] == runs and all(tuple(c) in known for s in seeds for c in s)
    assert not np.array_equal(seeds[1], seeds[2])
    fits = lloyd.fit_runs(df, FEATURES, "id", runs, 42, 200)
    for fit, start in zip(fits, seeds):
        centers, cost, near = plain_lloyd(x, start)
        assert np.allclose(fit.centers, centers, atol=1e-6) and fit.cost == pytest.approx(cost, rel=1e-9)
        got = [r[0] for r in df.select("id", fit.label(FEATURES).alias("k")).orderBy("id").select("k").collect()]
        assert got == near.tolist()


def test_best_start_of_every_k(spark):
    x, df = points(spark)
    best = lloyd.fit_kmeans(df, FEATURES, "id", {5: 6, 2: 3}, 1, 100)
    every = lloyd.fit_runs(df, FEATURES, "id", [5] * 6 + [2] * 3, 1, 100)
    for k in (2, 5):
        assert best[k].cost == pytest.approx(min(f.cost for f in every if f.k == k))
    assert best[5].cost < 0.5 * best[2].cost and len(best[5].centers) == 5


def test_seeds_are_drawn_by_squared_distance(spark):
    """Of two far groups, the second seed comes from the one that the first is not in."""
    rows = [(i, float(i % 2) * 1e4 + i * 1e-3) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double")
    blocks = materialize(lloyd.point_blocks(df, ["a"], "id"), "blocks")
    for first, second in lloyd.seed_centers(blocks, 1, [2] * 20, 7):
        assert abs(first[0] - second[0]) > 5e3


def test_few_different_rows_and_no_rows(spark):
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(50)], "id long, a double")
    fit = lloyd.fit_runs(df, ["a"], "id", [4], 3, 10)[0]
    assert sorted(fit.centers) == [(0.0,), (1.0,)] and fit.cost == 0.0
    with pytest.raises(ValueError):
        lloyd.fit_runs(df.filter("false"), ["a"], "id", [2], 3, 10)
