"""Column expressions and order-dependent building blocks on small fixtures."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.functions import ordering, quantiles, scalars
from stockweave.params import CalendarParams, FusionParams


def test_bins_are_right_closed(spark, rows):
    df = spark.createDataFrame(
        [(20.0, 0.0), (20.1, 1.0), (30.0, 1.1), (30.1, 10.0), (None, 10.1), (1000.0, None)], "t double, r double"
    )
    out = [tuple(r) for r in df.select(scalars.temp_bin(F.col("t")), scalars.rain_bin(F.col("r"))).collect()]
    assert out == [
        ("cold", "dry"), ("mild", "dry"), ("mild", "drizzle"), ("hot", "drizzle"), (None, "heavy"), (None, None),
    ]


def test_time_slots(spark):
    hours = [0, 3, 4, 5, 6, 11, 12, 17, 18, 21, 22, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(scalars.time_slot(F.col("h"))).collect()]
    assert got == ["night"] * 4 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2 + ["night"] * 2


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (2.51,)], "x double")
    assert [r[0] for r in df.select(scalars.half_even_int(F.col("x"))).collect()] == [0, 2, 2, 3]


def test_urgency_thresholds(spark):
    p = FusionParams()
    cases = [  # forecast, stock, days, level
        (0, 10, 1, 1), (6, 10, 30, 2), (7, 10, 30, 3), (8, 10, 30, 3), (9, 10, 30, 4),
        (11, 10, 3, 5), (11, 10, 4, 4), (10, 10, 0, 4), (1, 0, 30, 4),
    ]
    df = spark.createDataFrame(cases, "f int, s int, d int, want int")
    level = scalars.urgency_level(F.col("f"), F.col("s"), F.col("d"), p)
    got = df.withColumn("got", level).withColumn("label", scalars.urgency_label(F.col("got"))).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert got[5].label == "Critical" and got[0].label == "Watch"


def test_days_to_next(spark):
    dates = ["2014-03-17", "2014-10-03"]
    days = [date(2014, 3, 16), date(2014, 3, 17), date(2014, 3, 18), date(2014, 9, 30), date(2014, 10, 4)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(scalars.days_to_next(F.col("d"), dates, 30)).collect()]
    assert got == [1, 0, 30, 3, 30]
    assert df.select(scalars.days_to_next(F.col("d"), [], 30).alias("x")).filter("x <> 30").count() == 0


def test_default_calendar(spark):
    from stockweave.operators.calendar import event_calendar, event_calendar_summary

    days = spark.sql("SELECT explode(sequence(date'2013-01-01', date'2015-12-31')) AS date")
    cal = event_calendar(days, CalendarParams())
    assert (cal.count(), len(cal.columns)) == (1095, 7)
    summary = event_calendar_summary(cal).first()
    assert (summary.festival_days, summary.season_days) == (15, 54 + 47 + 47)
    assert cal.orderBy(F.desc("date")).first().days_to_festival == 30


def test_shares_and_spread(spark):
    ids = spark.range(40_000).withColumn("h", scalars.mixed_hash(F.col("id"), 3))
    shares = (("low", 35), ("mid", 45), ("high", 20))
    got = dict(ids.groupBy(scalars.pick_by_share(F.col("h"), shares)).count().collect())
    for label, share in shares:
        assert abs(got[label] / 400 - share) < 2
    assert ids.select("h").distinct().count() > 39_900
    low, high = ids.agg(F.min("h"), F.max("h")).first()
    assert low >= 0 and high < 2**31


def _series(n, hot_share=0.34):
    rng = random.Random(7)
    out, at = [], {}
    for i in range(n):
        user = 0 if rng.random() < hot_share else rng.randrange(1, 40)
        at[user] = at.get(user, 0) + 1
        out.append((user, i, at[user], float(rng.randrange(0, 30)) if rng.random() < 0.9 else None))
    return out


@pytest.mark.parametrize("parts", [1, 17])
def test_running_sum_matches_plain_loop(spark, parts):
    data = _series(3000)
    df = spark.createDataFrame(data, "user_id long, order_id long, n int, gap double").repartition(parts)
    got = ordering.running_sum(df, ["user_id"], "n", F.col("gap"), "total", block=64).select("order_id", "total").collect()
    want, sums = {}, {}
    for user, order, _, gap in data:
        sums[user] = sums.get(user, 0.0) + (gap or 0.0)
        want[order] = sums[user]
    assert {r.order_id: r.total for r in got} == want


def test_daily_positions(spark):
    data = [(1, date(2020, 1, 1), 5), (1, date(2020, 1, 1), 3), (1, date(2020, 1, 9), 1), (2, date(2020, 2, 2), 2)]
    df = spark.createDataFrame(data, "u long, d date, o long")
    got = {r.o: (r.position, r.prior_day) for r in ordering.daily_positions(df, ["u"], "d", ["o"]).collect()}
    assert got == {
        3: (1, None), 5: (2, date(2020, 1, 1)), 1: (3, date(2020, 1, 1)), 2: (1, None),
    }


@pytest.mark.parametrize("parts", [1, 17])
def test_capped_by_hash(spark, parts):
    df = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g")
    ).repartition(parts)
    got = ordering.capped_by_hash(df, ["g"], "id", 40, salt=5, blocks=16)
    ranked = df.withColumn("h", scalars.mixed_hash(F.col("id"), 5)).toPandas().sort_values(["g", "h", "id"])
    want = set(ranked.groupby("g").head(40).id)
    out = got.collect()
    assert {r.id for r in out} == want and len(out) == len(want)
    sizes = ranked.groupby("g").size().to_dict()
    assert all(r.group_size == sizes[r.g] for r in out)


def test_ordered_codes(spark):
    words = [f"{a}{b}" for a in "xyabc" for b in range(90)] + ["store_a", "store_b", None]
    df = spark.createDataFrame([(w,) for w in words * 2], "w string").repartition(5)
    got = {r.w: r.code for r in ordering.ordered_codes(df, "w", "code").collect()}
    want = {w: i for i, w in enumerate(sorted(words, key=lambda w: (w is not None, w or "")))}
    assert got == want


def test_exact_quantiles(spark):
    rng = np.random.default_rng(1)
    n = 30_001
    a = rng.lognormal(size=n)
    b = np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 9, n).astype(float))  # a hot value
    df = spark.createDataFrame(
        [(float(x), None if i % 10 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))], "a double, b double"
    ).repartition(7)
    probs = [0.0, 0.1, 0.35, 0.5, 0.75, 1.0]
    got = {(r.feature, r.probability): r.value for r in quantiles.exact_quantiles(df, ["a", "b"], probs).collect()}
    kept = np.array([y for i, y in enumerate(b) if i % 10])
    for p in probs:
        assert got["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert got["b", p] == pytest.approx(np.quantile(kept, p), rel=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 150, 151, 2500])
def test_exact_quantiles_of_few_rows(spark, n):
    x = np.random.default_rng(n).random(n)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.1, 0.25, 0.35, 0.5, 0.75, 0.9]
    got = {r.probability: r.value for r in quantiles.exact_quantiles(df, ["x"], probs).collect()}
    assert [got[p] for p in probs] == pytest.approx(list(np.quantile(x, probs)))


def test_value_codes_of_two_columns(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y"), ("c", "x")], "p string, q string")
    got = {(r["column"], r["value"]): r.code for r in ordering.value_codes(df, ["p", "q"]).collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("q", None): 0, ("q", "x"): 1, ("q", "y"): 2}


@pytest.mark.parametrize("block", [None, "a"])
def test_daily_positions_in_blocks(spark, block):
    rng = random.Random(4)
    days = [date(2020, 1, 1 + min(int(rng.expovariate(0.8)), 5)) for _ in range(300)]
    data = [(d, f"s{rng.randrange(3)}", i) for i, d in enumerate(days)]
    df = spark.createDataFrame(data, "d date, a string, b long").repartition(7)
    got = ordering.daily_positions(df, [], "d", ["a", "b"], block).orderBy("position").collect()
    want = sorted(data)
    assert [(r.d, r.a, r.b) for r in got] == want
    assert [r.position for r in got] == list(range(1, 301))
    assert [r.prior_day for r in got] == [None, *[w[0] for w in want[:-1]]]
