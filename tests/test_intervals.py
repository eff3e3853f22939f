"""Bands of each series from its own residuals."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from stockweave.operators import forecast


def residuals(spark, n=900):
    rng = random.Random(1)
    rows = [("s", p, float(i), rng.gauss(0, size)) for p, size in (("calm", 1.0), ("wild", 9.0)) for i in range(n)]
    rows += [("s", "new", 1.0, 5.0)]
    return spark.createDataFrame(rows, "store_id string, product_name string, part double, r double").withColumn("_a", F.abs("r"))


def test_exact_bands_are_the_conformal_rank(spark):
    df = residuals(spark)
    got = {r["product_name"]: r["band"] for r in forecast.exact_bands(df, 0.8).collect()}
    for name in ("calm", "wild"):
        own = sorted(r["_a"] for r in df.filter(F.col("product_name") == name).collect())
        assert got[name] == own[math.ceil(901 * 0.8) - 1]
    assert "new" not in got


def test_sketches_merge_within_the_rank_error(spark):
    df = residuals(spark)
    parts = forecast.residual_sketches(df.withColumn("part", F.col("part") % 7), ["part"])
    # Merging six parts and then the seventh is merging all.
    for sketches in (forecast.residual_sketches(df), forecast.merged_sketches(parts)):
        bands = {r["product_name"]: r["band"] for r in forecast.sketched_bands(sketches, 0.8).collect()}
        assert set(bands) == {"calm", "wild"}
        for name, band in bands.items():
            below = df.filter((F.col("product_name") == name) & (F.col("_a") <= band)).count()
            assert abs(below / 900 - 0.8) <= 0.027


@pytest.mark.parametrize("sketched", [False, True])
def test_bands_cover_calm_and_wild_series_alike(spark, sketched):
    rng = random.Random(4)
    rows = []
    for d in range(400):
        for k in range(10):
            rows.append((date.fromordinal(737425 + d), "s", f"p{k}", int(1000 + 100 * k + rng.gauss(0, 3 + 12 * k)), 1000.0 + 100 * k))
    df = spark.createDataFrame(rows, "order_date date, store_id string, product_name string, units_sold long, forecast double")
    folds = forecast.time_series_folds(df)
    got = forecast.interval_hit_rate(folds, F.col("forecast"), sketched=sketched).orderBy("decile").collect()
    assert [r["decile"] for r in got] == list(range(10)) and sum(r["test_rows"] for r in got) == 4000 // 6
    assert sum(r["hit_rate"] * r["test_rows"] for r in got) / 666 == pytest.approx(0.8, abs=0.03 if not sketched else 0.05)
    assert got[9]["mean_band"] > 5 * got[0]["mean_band"]
