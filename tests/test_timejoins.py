"""Joins by time against plain searches."""

import random
from datetime import datetime, timedelta

import pytest

from stockweave.operators.timejoins import asof_join, interval_join

START = datetime(2020, 1, 1)


def made(n, keys, seed, span=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows has one key; some keys and times are null.
        key = "hot" if i % 3 == 0 else rng.choice([*keys, None])
        at = None if rng.random() < 0.05 else START + timedelta(days=rng.randrange(span))
        rows.append((i, key, at))
    return rows


@pytest.mark.parametrize("forward", [True, False])
def test_asof_against_plain_search(spark, forward):
    lefts, rights = made(400, "abc", 1), made(300, "abd", 2)
    left = spark.createDataFrame(lefts, "id long, key string, at timestamp").repartition(7)
    right = spark.createDataFrame(rights, "k long, key string, seen timestamp").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = asof_join(left, right, ["key"], "at", "seen", "met", forward)
        assert out.columns == ["id", "key", "at", "met"]
        got = {r["id"]: r["met"] and tuple(r["met"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for i, key, at in lefts:
        near = [r for r in rights if None not in (key, at, r[2]) and r[1] == key and (r[2] >= at if forward else r[2] <= at)]
        when = (min if forward else max)((r[2] for r in near), default=None)
        want[i] = (min if forward else max)((r for r in near if r[2] == when), default=None)
    assert got == want and any(want.values())


def test_asof_of_nothing(spark):
    left = spark.createDataFrame([(1, "a", START), (2, None, None)], "id long, key string, at timestamp")
    right = spark.createDataFrame([], "k long, key string, seen timestamp")
    assert [r["met"] for r in asof_join(left, right, ["key"], "at", "seen", "met").collect()] == [None, None]
    assert asof_join(left.filter("false"), right, ["key"], "at", "seen", "met").collect() == []


@pytest.mark.parametrize("kind", ["long", "timestamp"])
def test_intervals_against_plain_search(spark, kind):
    rng = random.Random(4)
    points = [(i, rng.choice(["hot", "a", "b", None]), None if i % 17 == 0 else rng.randrange(-500, 500)) for i in range(300)]
    windows = []
    for i in range(120):
        start = rng.randrange(-500, 500)
        windows.append((i, rng.choice(["hot", "a", "c"]), start, start + rng.choice([0, 1, 3, 7, 64, 800, -5])))
    windows += [(900, "a", None, 3), (901, "a", 3, None), (902, "hot", -10_000, 10_000)]
    at = (lambda v: v) if kind == "long" else (lambda v: None if v is None else START + timedelta(hours=v))
    p = spark.createDataFrame([(i, k, at(t)) for i, k, t in points], f"p long, key string, t {kind}")
    w = spark.createDataFrame([(i, k, at(a), at(b)) for i, k, a, b in windows], f"w long, key string, a {kind}, b {kind}")
    got = [(r["p"], r["w"]) for r in interval_join(p, w, ["key"], "t", "a", "b").collect()]
    want = [(i, j) for i, k, t in points for j, key, a, b in windows if None not in (k, t, a, b) and k == key and a <= t <= b]
    assert sorted(got) == sorted(want) and len(want) > 400
    assert interval_join(p, w.filter("w < 0"), ["key"], "t", "a", "b").collect() == []
    assert interval_join(p, w.filter("b < a"), ["key"], "t", "a", "b").collect() == []
