"""Operators on small fixtures, against plain Python where the answer is not obvious."""

import itertools
import random
from dataclasses import replace
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from stockweave.operators import (
    baskets,
    demand,
    demographics,
    density,
    features,
    forecast,
    fusion,
    master,
    matching,
    profile,
    rules,
    segments,
)
from stockweave.params import ForecastParams, FusionParams, MiningParams, SegmentParams
from stockweave.sources import raw, weather


# ---- sources ---------------------------------------------------------------


def test_csv_by_name_and_missing_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("extra,user_id,order_id\nx,7,1\ny,8,2\n")
    df = raw.read_csv(spark, str(tmp_path / "a.csv"), "order_id long, user_id long")
    assert sorted(tuple(r) for r in df.collect()) == [(1, 7), (2, 8)]
    with pytest.raises(Exception, match="nowhere"):
        raw.load_raw(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="eval_set"):
        raw.read_csv(spark, str(tmp_path / "a.csv"), "eval_set string")


def test_csv_folder_with_another_header_fails(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("user_id,order_id\n100,1\n")
    (folder / "b.csv").write_text("order_id,user_id\n2,200\n")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_csv(spark, str(folder), "order_id long, user_id long").collect()


def test_csv_nan_is_null(spark, tmp_path):
    (tmp_path / "n.csv").write_text("order_id,days_since_prior_order\n1,NaN\n2,\n3,4.5\n")
    rows = raw.read_csv(spark, str(tmp_path / "n.csv"), "order_id long, days_since_prior_order double").collect()
    assert sorted((r.order_id, r.days_since_prior_order) for r in rows) == [(1, None), (2, None), (3, 4.5)]


def test_weather_json(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"daily": {"time": ["2013-01-01", "2013-01-02"], "temperature_2m_max": [31.5, null],'
        ' "precipitation_sum": [0.0, 12.5], "weathercode": [3, 61]}, "other": 1}'
    )
    out = weather.with_weather_bins(weather.read_weather_json(spark, str(tmp_path / "w.json"))).orderBy("date").collect()
    assert [tuple(r) for r in out] == [
        (date(2013, 1, 1), 31.5, 0.0, 3, "hot", "dry"), (date(2013, 1, 2), None, 12.5, 61, None, "heavy"),
    ]


def test_partitioned_sink(spark, tmp_path, rows):
    df = spark.range(100).select("id", F.when(F.col("id") < 40, "hot").otherwise("cold").alias("store_id"))
    path = raw.write_parquet(df, str(tmp_path / "out"), ("store_id",))
    assert rows(spark.read.parquet(path), "id", "store_id") == rows(df, "id", "store_id")


# ---- master and features ---------------------------------------------------


@pytest.fixture(scope="module")
def raw_tables(spark):
    orders = [  # order, user, set, number, dow, hour, gap
        (1, 10, "prior", 1, 0, 23, None), (2, 10, "prior", 2, 3, 12, 7.0), (3, 10, "prior", 3, 6, 3, 5.0),
        (4, 11, "prior", 1, 2, 4, None), (5, 11, "train", 2, 2, 10, 9.0),
    ]
    lines = [(1, 100, 0), (1, 101, 0), (2, 100, 1), (3, 100, 1), (3, 102, 0), (4, 101, 0), (5, 100, 0)]
    products = [(100, "ORGANIC milk", 1, 1), (101, "bread", 2, 1), (102, None, 2, 2), (103, "lost", 9, 1)]
    return {
        "orders": spark.createDataFrame(orders, raw.RAW_SCHEMAS["orders"]),
        "order_products": spark.createDataFrame(lines, raw.RAW_SCHEMAS["order_products"]),
        "products": spark.createDataFrame(products, raw.RAW_SCHEMAS["products"]),
        "aisles": spark.createDataFrame([(1, "dairy"), (2, "bakery")], raw.RAW_SCHEMAS["aisles"]),
        "departments": spark.createDataFrame([(1, "fresh"), (2, "misc")], raw.RAW_SCHEMAS["departments"]),
    }


def test_build_master(raw_tables):
    out = master.build_master(**raw_tables)
    assert out.columns == list(master.MASTER_COLUMNS)
    assert out.count() == 6 and out.filter("order_id = 5").count() == 0
    assert master.distinct_orders(out).count() == 4


def test_user_rfm(raw_tables):
    got = {r.user_id: r for r in features.user_rfm(master.build_master(**raw_tables)).collect()}
    u = got[10]
    assert (u.recency, u.frequency, u.avg_basket_size) == (0.0, 3, pytest.approx(5 / 3))
    assert u.reorder_ratio == pytest.approx(2 / 5) and u.monetary_proxy == pytest.approx(2 / 3)
    assert u.night_owl_score == pytest.approx(2 / 3) and u.weekend_concentration == pytest.approx(2 / 3)
    assert u.organic_affinity == pytest.approx(3 / 5) and u.avg_days_between_orders == 6.0
    v = got[11]  # one order, no gap: sums and means of nothing are 0
    assert (v.recency, v.avg_days_between_orders, v.night_owl_score) == (12.0, 0.0, 0.0)


def test_order_dates_follow_gaps_and_are_capped(raw_tables):
    m = master.build_master(**raw_tables)
    first = m.sparkSession.createDataFrame([(10, date(2013, 5, 1))], "user_id long, first_order_date date")
    d = {r.order_id: r.order_date for r in features.assign_order_dates(m, first).collect()}
    assert d == {1: date(2013, 5, 1), 2: date(2013, 5, 8), 3: date(2013, 5, 13), 4: None}
    capped = features.assign_order_dates(m, first, date(2013, 5, 2)).filter("user_id = 10")
    assert {r.order_date for r in capped.collect()} == {date(2013, 5, 1), date(2013, 5, 2)}


def test_rain_null_counts_in_denominator(spark):
    ctx = spark.createDataFrame(
        [(1, 25.0, 5.0, 0), (1, None, None, 1), (1, 35.0, 1.0, 0)],
        "user_id long, temp_max double, precipitation double, is_festival int",
    ).withColumns({"is_ipl_match_day": F.lit(0), "is_monsoon": F.lit(1)})
    r = features.user_context(ctx).first()
    assert (r.avg_temp_max, r.pct_rainy_orders, r.pct_monsoon_orders) == (30.0, pytest.approx(1 / 3), 1.0)


def test_store_assignment(spark):
    orders = spark.createDataFrame([(1,), (1,), (2,)], "user_id long")
    areas = spark.createDataFrame([(1, "p", "c", "s"), (9, "q", "d", "t")], "user_id long, pin_code string, city string, store_id string")
    got = {tuple(r) for r in demographics.assign_stores(orders, areas).collect()}
    assert got == {(1, "p", "c", "s"), (2, None, None, None)}


# ---- profile ---------------------------------------------------------------


def test_histogram_edges(spark, rows):
    df = spark.createDataFrame([(1.0,), (2.0,), (59.9,), (60.0,), (60.5,), (0.5,), (None,)], "x double")
    assert rows(profile.histogram(df, "x", 50, 1, 60)) == [(1, 2), (50, 2)]
    flat = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert rows(profile.histogram(flat, "x", 30)) == [(1, 2)]


def test_null_profile_and_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "a")], "k int, v string")
    assert rows(profile.null_profile(df)) == [("v", 1)]
    assert rows(profile.distinct_counts(df, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(profile.distinct_counts(df, ["k", "v"], approximate=True)) == [("k", 2), ("v", 1)]


def test_copurchase_matches_pearson(spark):
    rng = random.Random(3)
    lines = [(o, f"p{rng.randrange(9)}") for o in range(300) for _ in range(rng.randrange(1, 6))]
    got = profile.copurchase_corr(spark.createDataFrame(lines, "order_id long, product_name string"), 5).collect()
    count = {}
    for _, p in lines:
        count[p] = count.get(p, 0) + 1
    top = sorted(count, key=lambda p: (-count[p], p))[:5]
    orders = sorted({o for o, p in lines if p in top})
    have = {(o, p) for o, p in lines}
    m = np.array([[(o, p) in have for p in top] for o in orders], dtype=float)
    corr = np.corrcoef(m.T)
    assert len(got) == 10
    for r in got:
        assert r.correlation == pytest.approx(corr[top.index(r.product_a), top.index(r.product_b)])


# ---- demand ----------------------------------------------------------------


def _daily(spark):
    rng = random.Random(5)
    data = [
        (date(2020, 1, 1 + d), s, p, rng.randrange(1, 5))
        for d in range(0, 31) for s in ("s1", "s2") for p in ("a", "b", "c") if rng.random() < 0.5 or d in (0, 30)
    ]
    data += [(date(2020, 2, 9), "s1", "a", 3)]
    return spark.createDataFrame(data, "order_date date, store_id string, product_name string, units_sold long"), data


def test_spine_is_gap_free(spark):
    daily, data = _daily(spark)
    spine = demand.demand_spine(daily, 2)
    kept = {r.product_name for r in spine.select("product_name").distinct().collect()}
    days = (date(2020, 2, 9) - date(2020, 1, 1)).days + 1
    assert len(kept) == 2 and spine.count() == days * 2 * 2
    assert spine.agg(F.sum("units_sold")).first()[0] == sum(u for _, _, p, u in data if p in kept)


def test_spine_covers_what_occurs_over_several_tasks(spark):
    daily, data = _daily(spark)
    daily = daily.filter("store_id = 's1' OR product_name <> 'c'")
    spine = demand.demand_spine(daily)
    series = {(r.store_id, r.product_name) for r in spine.select("store_id", "product_name").distinct().collect()}
    assert series == {("s1", "a"), ("s1", "b"), ("s1", "c"), ("s2", "a"), ("s2", "b")}
    plan = spine._jdf.queryExecution().executedPlan().toString()
    days, spread = plan.index("Generate explode"), plan.index("REPARTITION_BY_NUM")
    assert days < spread and "hashpartitioning(product_name" in plan[plan.rindex("Exchange", 0, spread) : spread]


def test_lags_and_rolling(spark):
    daily, _ = _daily(spark)
    spine = demand.demand_spine(daily, 3)
    got = demand.lag_features(spine).toPandas()
    plain = spine.toPandas().sort_values(["store_id", "product_name", "order_date"])
    g = plain.groupby(["store_id", "product_name"]).units_sold
    for k in (1, 7, 14, 30):
        plain[f"lag_{k}d"] = g.shift(k)
    plain["m7"] = g.transform(lambda x: x.shift(1).rolling(7, min_periods=1).mean())
    plain["s7"] = g.transform(lambda x: x.shift(1).rolling(7, min_periods=1).std().fillna(0))
    plain["m30"] = g.transform(lambda x: x.shift(1).rolling(30, min_periods=1).mean())
    plain = plain.dropna(subset=["lag_30d"])
    keys = ["store_id", "product_name", "order_date"]
    both = got.merge(plain, on=keys, suffixes=("", "_want"))
    assert len(both) == len(got) == len(plain)
    for k in (1, 7, 14, 30):
        assert (both[f"lag_{k}d"] == both[f"lag_{k}d_want"]).all()
    for a, b in (("rolling_7d_mean", "m7"), ("rolling_7d_std", "s7"), ("rolling_30d_mean", "m30")):
        assert np.allclose(both[a], both[b])


def test_label_encode_null_is_nan(spark, rows):
    df = spark.createDataFrame([("b",), (None,), ("z",)], "x string")
    assert rows(demand.label_encode(df, {"x": "c"}).fillna("?")) == [("?", 1), ("b", 0), ("z", 2)]


# ---- forecast --------------------------------------------------------------


def test_folds(spark):
    n = 65
    data = [(date.fromordinal(737425 + i // 4), "s", f"p{i % 4}", 1 + i % 3, i % 5) for i in range(n)] + [
        (date(2019, 1, 1), "s", "zero", 0, 0)
    ]
    df = spark.createDataFrame(data, "order_date date, store_id string, product_name string, units_sold long, lag_7d long")
    folds = forecast.time_series_folds(df.repartition(5)).orderBy("position").collect()
    assert [r.position for r in folds] == list(range(1, n + 1))
    size = n // 6
    want = [None] * (n - 5 * size) + [f for f in range(1, 6) for _ in range(size)]
    assert [r.test_fold for r in folds] == want
    naive = forecast.naive_baseline(forecast.time_series_folds(df)).orderBy("test_fold").collect()
    last = [r for r in folds if r.test_fold == 5]
    mape = np.mean([abs(r.units_sold - r.lag_7d) / (r.units_sold + 1) for r in last]) * 100
    assert naive[-1].naive_mape == pytest.approx(mape)


def test_boosted_trees_learn_and_explain(spark):
    rng = random.Random(2)
    data = []
    for d in range(90):
        for p in ("a", "b"):
            x = rng.randrange(0, 8)
            data.append((date.fromordinal(737425 + d), "s", p, 1 + 2 * x, x, rng.random()))
    df = spark.createDataFrame(data, "order_date date, store_id string, product_name string, units_sold long, lag_7d long, noise double")
    p = ForecastParams(rounds=40, step=0.3, leaves=4, min_leaf_rows=1, features=("lag_7d", "noise"))
    fit = forecast.fit_boosted(df, p)
    acc = fit.accuracy.first()
    assert acc.mape < 10 < acc.naive_mape and acc.improvement_pct > 50
    out = forecast.boosted_forecast(df, fit, p)
    assert out.columns == list(forecast.FORECAST_COLUMNS) and out.count() == len(data)
    assert out.filter("forecast_units < 0").count() == 0
    first = forecast.feature_importance(fit, p).first()
    assert first.feature == "lag_7d" and first.mape_increase > 10
    assert forecast.feature_attribution(fit).first().feature == "lag_7d"
    report = forecast.fold_report(fit).orderBy("test_fold").collect()
    assert [r.test_fold for r in report] == [1, 2, 3, 4, 5] and all(r.improvement_pct > 0 for r in report)
    one = forecast.fit_boosted(df, replace(p, rounds=1))
    assert len(fit.model.trees) > 1 and acc.mape < one.accuracy.first().mape


# ---- baskets and rules -----------------------------------------------------


def _enriched(spark, orders):
    data = [(o, o, i, s, "night", "dry") for o, (s, items) in enumerate(orders) for i in items]
    return spark.createDataFrame(
        data, "order_id long, user_id long, product_name string, segment string, time_slot string, weather_bin string"
    ), data


def _brute_rules(orders, p):
    """All itemsets and rules of every slice, by enumeration."""
    out, sets_out = {}, {}
    for seg in {s for s, _ in orders}:
        mine = [set(items) for s, items in orders if s == seg]
        n = len(mine)
        if n < p.min_orders:
            continue
        count = {}
        for b in mine:
            for i in b:
                count[i] = count.get(i, 0) + 1
        top = sorted(count, key=lambda i: (-count[i], i))[: p.top_items]
        baskets_ = [b & set(top) for b in mine]
        freq = {}
        for size in range(1, (p.max_len or len(top)) + 1):
            for c in itertools.combinations(sorted(top), size):
                k = sum(set(c) <= b for b in baskets_)
                if k / n >= p.min_support:
                    freq[frozenset(c)] = k
        sets_out[seg] = {tuple(sorted(s)): k for s, k in freq.items()}
        for s, k in freq.items():
            for r in range(1, len(s)):
                for a in itertools.combinations(sorted(s), r):
                    a = frozenset(a)
                    conf, lift = k / freq[a], k * n / (freq[a] * freq[s - a])
                    if conf >= p.min_confidence and lift >= p.min_lift:
                        out[seg, ", ".join(sorted(a)), ", ".join(sorted(s - a))] = (k / n, conf, lift)
    return sets_out, out


@pytest.mark.parametrize("max_len", [None, 2, 3])
def test_rules_match_enumeration(spark, max_len):
    rng = random.Random(11)
    orders = []
    for i in range(240):
        seg = "hot" if i % 3 == 0 else f"s{i % 2}"
        items = {f"i{min(int(rng.expovariate(0.5)), 7)}" for _ in range(rng.randrange(1, 6))}
        orders.append((seg, items | ({"i0", "i1", "i2", "i3"} if rng.random() < 0.2 else set())))
    orders += [("hot", {"i0", "i1"})] * 60  # a group of copies
    orders.append(("tiny", {"i0", "i1"}))
    p = MiningParams(min_orders=20, top_items=6, min_support=0.05, max_len=max_len)
    enriched, _ = _enriched(spark, orders)
    want_sets, want = _brute_rules(orders, p)
    sets = baskets.context_itemsets(enriched.repartition(9), p).collect()
    got_sets = {}
    for r in sets:
        got_sets.setdefault(r.segment, {})[tuple(r["items"])] = r.cnt
    assert got_sets == want_sets
    if max_len is None:
        assert max(len(s) for v in want_sets.values() for s in v) >= 4
    got = {(r.segment, r.antecedent, r.consequent): (r.support, r.confidence, r.lift)
           for r in rules.context_rules(enriched, p).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    for (seg, a, c), v in got.items():
        if (seg, c, a) in got:
            assert v[2] == pytest.approx(got[seg, c, a][2])


def test_empty_orders_stay_in_denominator(spark):
    orders = [("s", {"a", "b", "c"})] * 3 + [("s", {"a"})] + [("s", {"z"})]
    p = MiningParams(min_orders=1, top_items=3, min_support=0.1)
    enriched, _ = _enriched(spark, orders)
    sets = {tuple(r["items"]): r.support for r in baskets.context_itemsets(enriched, p).collect()}
    assert sets["a",] == 0.8 and sets["a", "b", "c"] == 0.6 and ("z",) not in sets


def test_order_cap_applies(spark):
    orders = [("s", {"a", "b"})] * 200
    p = MiningParams(min_orders=10, max_orders=50, min_support=0.1)
    enriched, _ = _enriched(spark, orders)
    assert baskets.slice_order_cap(enriched, p).count() == 50
    sets = baskets.context_itemsets(enriched, p).collect()
    assert {r.cnt for r in sets} == {50} and {r.support for r in sets} == {1.0}


def test_coverage_counts_the_mined_orders(spark):
    orders = [("s", {"a", "b"})] * 200 + [("s", {"c", "d"})] * 200
    enriched, _ = _enriched(spark, orders)
    shares = []
    for cap in (None, 100):
        p = MiningParams(min_orders=10, max_orders=cap, min_support=0.1)
        start = baskets.slice_baskets(enriched, p)
        row = rules.rule_coverage(start, rules.rules_from(start, p), p).first()
        assert row.n_orders == (cap or 400)
        shares.append(row.coverage)
    assert shares == [1.0, 1.0]


def test_nothing_is_cut_unless_asked(spark):
    """More frequent items than fifty, and an itemset of six."""
    orders = [("s", {f"i{k}", f"j{k}", f"k{k}", f"l{k}", f"m{k}", f"n{k}"}) for k in range(20) for _ in range(2)]
    enriched, _ = _enriched(spark, orders)
    sets = baskets.context_itemsets(enriched, MiningParams(min_orders=10, min_support=0.02)).collect()
    assert sum(r.n_items == 1 for r in sets) == 120 and sum(r.n_items == 6 for r in sets) == 20


def test_top_items_are_pruned_before_the_shuffle(spark):
    enriched, _ = _enriched(spark, [("s", {"a", "b"})] * 20)
    p = MiningParams(top_items=1, max_orders=100, min_orders=1)
    present = enriched.select(*p.slice_cols, "order_id", F.col("product_name").alias("item"), F.lit(20).alias("n_orders"))
    top = baskets.slice_top_items(baskets.slice_item_counts(present, p), p)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert [(r["item"], r["rank"]) for r in top.collect()] == [("a", 0)]


def test_coverage_and_best_rule(spark):
    orders = [("s", {"a", "b"})] * 6 + [("s", {"c"})] * 4 + [("s", {"d", "e", "f"})] * 2
    p = MiningParams(min_orders=1, min_support=0.1)
    enriched, _ = _enriched(spark, orders)
    start = baskets.slice_baskets(enriched, p)
    found = rules.rules_from(start, p)
    cov = rules.rule_coverage(start, found, p).first()
    assert (cov.n_orders, cov.covered_orders) == (12, 8)
    best = {r.antecedent: r.consequent for r in rules.best_rule_per_item(found).collect()}
    assert best == {"a": "b", "b": "a", "d": "e", "e": "d", "f": "d"}
    actions = spark.createDataFrame([("a", "s"), ("q", "s")], "product_name string, dominant_segment string")
    got = {r.product_name: r.bundle_with for r in fusion.attach_bundles(actions, found, segment_first=True).collect()}
    assert got == {"a": "b", "q": None}


# ---- segmentation ----------------------------------------------------------


def _blobs(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(scale=4, size=(3, dims))
    label = rng.integers(0, 3, n)
    return centers[label] + rng.normal(size=(n, dims)), label


def _frame(spark, x, label=None):
    cols = [f"f{i}" for i in range(x.shape[1])]
    data = [(i, int(label[i]) if label is not None else 0, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(data, ["user_id", "cluster_id", *cols]).withColumn("cluster_id", F.col("cluster_id").cast("int")), cols


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, None, 5.0), (3, 3.0, 5.0), (4, 8.0, 5.0)], "user_id long, a double, b double")
    got = segments.scaled_features(df, SegmentParams(features=("a", "b"))).orderBy("user_id").collect()
    a = np.array([1, 3, 3, 8.0])
    assert [r.a for r in got] == pytest.approx(list((a - a.mean()) / a.std())) and {r.b for r in got} == {0.0}


def test_silhouette_and_davies_bouldin(spark):
    x, label = _blobs(150, 3)
    df, cols = _frame(spark, x, label)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = (label == label[i]).sum()
        a = d[i][label == label[i]].sum() / (own - 1)
        b = min(d[i][label == c].mean() for c in set(label) - {label[i]})
        s.append((b - a) / max(a, b))
    got = segments.sampled_silhouettes(df, cols, ["cluster_id"], "user_id", block=40).first().silhouette
    assert got == pytest.approx(np.mean(s))
    cent = np.array([x[label == c].mean(0) for c in range(3)])
    spread = [np.sqrt(((x[label == c] - cent[c]) ** 2).sum(1)).mean() for c in range(3)]
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(cent[i] - cent[j]) for j in range(3) if j != i) for i in range(3)]
    assert segments.davies_bouldin(df, cols, "cluster_id").first()[0] == pytest.approx(np.mean(worst))
    by_square = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id").evaluate(segments.with_vector(df, cols))
    assert segments.silhouette(df, cols, "cluster_id").first()[0] == pytest.approx(by_square)


def _noise(x, eps, k):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= k
    return ~core & ~(near & core[None]).any(1)


@pytest.mark.parametrize(
    "dims,eps,k,tile,block_dims", [(2, 0.3, 6, 50, None), (4, 0.9, 8, 1000, 2), (3, 0.7, 10, 20, 3), (1, 0.05, 5, 7, 1)]
)
def test_density_noise_matches_all_pairs(spark, dims, eps, k, tile, block_dims):
    x, _ = _blobs(400, dims, seed=dims)
    x = np.vstack([x, np.repeat(x[:1], 200, axis=0), np.full((3, dims), 40.0)])  # copies, and a far trio
    df, cols = _frame(spark, x)
    got = {r.user_id: r.is_noise for r in density.density_noise(df.repartition(6), cols, "user_id", eps, k, tile, block_dims).collect()}
    want = _noise(x, eps, k)
    assert [got[i] for i in range(len(x))] == [int(v) for v in want]
    assert 0 < want.sum() < len(x)


@pytest.mark.parametrize("dims,eps,k,leaf,tile", [(2, 0.3, 6, 60, 16), (4, 0.9, 8, 40, 1000), (12, 3.2, 10, 50, 32)])
def test_density_noise_over_leaves(spark, dims, eps, k, leaf, tile):
    """Neighbours of one point in many leaves, cores that only other leaves tell, copies over a cut."""
    x, _ = _blobs(500, dims, seed=dims + 1)
    x = np.vstack([x, np.repeat(x[:40], 3, axis=0), np.full((3, dims), 40.0), np.full((k, dims), -50.0)])
    df, cols = _frame(spark, x)
    noise = density.density_noise(df.repartition(5), cols, "user_id", eps, k, tile, leaf_rows=leaf)
    got = {r.user_id: r.is_noise for r in noise.collect()}
    want = _noise(x, eps, k)
    assert [got[i] for i in range(len(x))] == [int(v) for v in want]
    assert 0 < want.sum() < len(x)


def test_density_sends_open_points_only(spark):
    """What leaves a leaf are points it could not settle, each once per other leaf near it: the rows that meet
    stay near the number of points, where whole tiles for every pair of tiles were many times as many."""
    x = np.random.default_rng(3).normal(size=(4000, 6))
    df, cols = _frame(spark, x)
    known = density.distinct_points(df, cols)
    leaves = density.point_leaves(known, len(x), 6, None, 500)
    home = density.settle_at_home(known, leaves, 1.2, 5, 100).localCheckpoint()
    sizes = [r.n for r in home.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == len(leaves) >= 6 and max(sizes) <= 750
    open_rows = home.filter("NOT core").count()
    met = density.meet_elsewhere(home, leaves, 1.2, 5, 100, 500)
    assert open_rows < len(x) / 2 and met.count() <= open_rows
    assert met.filter(F.size("others") >= 5 * len(leaves)).count() == 0


def test_density_noise_unknown_coordinates(spark):
    nan, inf = float("nan"), float("inf")
    data = [(i, 0.01 * i, 0.0) for i in range(6)] + [(6, nan, 7.0), (7, 0.0, inf), (8, None, 0.0), (9, None, 9.0)]
    data += [(10 + i, None, 5.0) for i in range(5)]  # five equal rows count as a crowd
    df = spark.createDataFrame(data, "user_id long, a double, b double")
    got = {r.user_id: r.is_noise for r in density.density_noise(df, ["a", "b"], "user_id", 1.0, 5).collect()}
    assert [i for i, v in sorted(got.items()) if v] == [6, 7, 8, 9] and len(got) == len(data)
    none = density.density_noise(df.filter("user_id > 99"), ["a", "b"], "user_id", 1.0, 5)
    assert none.collect() == []


def test_outlier_labels_make_the_noise_once(spark):
    made = spark.sparkContext.accumulator(0)

    def flag(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    noise = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "user_id long, is_noise int")
    labels = spark.createDataFrame([(i, i % 3) for i in range(2, 44)], "user_id long, cluster_id int")
    out = segments.outlier_labels(labels, noise.mapInArrow(flag, noise.schema)).collect()
    want = {(i, 3 if i % 4 == 0 else i % 3, 3) for i in range(2, 40)}
    assert {tuple(r) for r in out} == want and len(out) == len(want)
    assert made.value == 40


def test_border_point_is_not_noise(spark):
    x = np.array([[i * 0.01, 0.0] for i in range(12)] + [[1.15, 0.0], [9.0, 9.0]])
    df, cols = _frame(spark, x)
    got = {r.user_id: r.is_noise for r in density.density_noise(df, cols, "user_id", 1.12, 10).collect()}
    assert got[12] == 0 and got[13] == 1 and sum(got.values()) == 1


def test_persona_names(spark):
    base = dict(frequency=10.0, avg_basket_size=5.0, night_owl_score=0.1, organic_affinity=0.1,
                weekend_concentration=0.1, pct_festival_orders=0.1)
    table = [
        dict(base, cluster_id=0, night_owl_score=0.9), dict(base, cluster_id=1, organic_affinity=0.9),
        dict(base, cluster_id=2, weekend_concentration=0.9), dict(base, cluster_id=3, pct_festival_orders=0.9),
        dict(base, cluster_id=4, frequency=1.0, avg_basket_size=1.0), dict(base, cluster_id=5),
        dict(base, cluster_id=6, night_owl_score=0.95),
    ]
    profile_ = spark.createDataFrame(table)
    got = {r.cluster_id: r.cluster_name for r in segments.persona_names(profile_, F.lit(6)).collect()}
    assert got == {
        0: "late_night_bachelor", 1: "morning_health_buyer", 2: "weekend_family_shopper", 3: "festival_bulk_buyer",
        4: "student_exam_buyer", 5: "impulse_buyer", 6: "power_user",
    }


def test_segmentation_end_to_end(spark):
    x, label = _blobs(300, 12, seed=4)
    p = SegmentParams(k_values=(2, 3, 4), restarts=2, sweep_restarts=2, max_iter=10, eps=1.0, min_samples=5)
    cols = list(p.features)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["user_id", *cols])
    scaled = segments.scaled_features(df, p)
    sweep = segments.k_selection(scaled, p).orderBy("k").collect()
    assert [r.k for r in sweep if r.best] == [3]
    out = segments.segment_labels(df, 3, p)
    assert out.count() == 300 and set(out.columns) == {"user_id", "cluster_id", "cluster_name"}
    noise = density.density_noise(scaled, cols, "user_id", p.eps, p.min_samples).filter("is_noise = 1").count()
    assert out.filter("cluster_name = 'power_user'").count() == noise
    proj = segments.pca_projection(scaled, segments.kmeans_segments(scaled, 3, p), p)
    z = np.array([r for r in scaled.orderBy("user_id").select(*cols).toPandas().to_numpy()])
    share = np.linalg.eigvalsh(np.cov(z.T))[::-1]
    got = proj.first()
    assert got.pc1_share == pytest.approx(share[0] / share.sum()) and proj.count() == 300


# ---- fusion ----------------------------------------------------------------


@pytest.fixture(scope="module")
def forecasts(spark):
    data = [
        (date(2020, 1, 1), "s1", "a", 10, 1), (date(2020, 1, 2), "s1", "a", 0, 9), (date(2020, 1, 2), "s1", "b", 0, 3),
        (date(2020, 1, 1), "s2", "a", 5, 2), (date(2020, 1, 2), "s2", "a", 0, 0),
    ]
    df = spark.createDataFrame(data, "order_date date, store_id string, product_name string, units_sold long, forecast_units int")
    return df.withColumns({"model_type": F.lit("m"), "mape": F.lit(1.0)})


def test_stock_and_latest(forecasts, rows):
    stock = fusion.current_stock(forecasts)
    assert rows(stock, "store_id", "product_name", "current_stock") == [("s1", "a", 8), ("s2", "a", 4)]  # b never sold
    assert rows(fusion.latest_forecast(forecasts), "store_id", "product_name", "forecast_units") == [
        ("s1", "a", 9), ("s1", "b", 3), ("s2", "a", 0),
    ]


def test_action_list(spark, forecasts):
    seg = spark.createDataFrame([(1, 0, "x"), (2, 1, "y"), (3, 1, "y"), (4, 0, "x")], "user_id long, cluster_id int, cluster_name string")
    demo = spark.createDataFrame([(1, "s1"), (2, "s1"), (3, "s1"), (4, "s2"), (2, "s2")], "user_id long, store_id string")
    cal = spark.createDataFrame(
        [(date(2020, 1, 2), 2, 0, 1, 0), (date(2020, 12, 31), 30, 0, 0, 1)],
        "date date, days_to_festival int, is_festival int, is_ipl_match_day int, is_monsoon int",
    )
    found = spark.createDataFrame(
        [("a", "b", 2.0, ["a"], ["b"], "y"), ("a", "c", 3.0, ["a"], ["c"], "x"), ("a, b", "c", 9.0, ["a", "b"], ["c"], "x")],
        "antecedent string, consequent string, lift double, antecedents array<string>, consequents array<string>, segment string",
    )
    args = (forecasts, fusion.current_stock(forecasts), fusion.dominant_segment(seg, demo), found, cal, datetime(2020, 1, 3, 9, 45))
    out = fusion.ranked(fusion.build_action_list(*args)).collect()
    assert [(r.store_id, r.product_name, r.urgency, r.reorder_qty) for r in out] == [("s1", "a", 4, 1), ("s2", "a", 1, 0)]
    assert (out[0].bundle_with, out[0].bundle_lift, out[0].dominant_segment) == ("c", 3.0, "y")
    assert (out[0].event_context, out[1].dominant_segment, out[0].generated_at) == ("monsoon", "x", datetime(2020, 1, 3, 9))
    as_of = fusion.build_action_list(*args, FusionParams(event_mode="as_of")).filter("store_id = 's1'").first()
    assert (as_of.urgency_label, as_of.event_context) == ("Critical", "ipl_season")
    kpis = {r.store_id: r for r in fusion.store_kpis(fusion.build_action_list(*args)).collect()}
    assert (kpis["s1"].skus, kpis["s1"].stockout_risk, kpis["s2"].stockout_risk) == (1, 1, 0)


# ---- matching --------------------------------------------------------------


def test_fuzzy_match_equals_all_pairs(spark):
    rng = random.Random(9)
    words = [" ".join(rng.choice(["organic", "red", "milk", "mild", "tea"]) for _ in range(2)) for _ in range(30)]
    names = sorted({"".join(c for c in w if rng.random() > 0.08) for w in words} | {"", "a"})
    catalogue = sorted(set(words) | {"ab"})

    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    got = {
        r.product_name: (r.distance, r.match_name)
        for r in matching.fuzzy_product_match(
            spark.createDataFrame([(n,) for n in names], "product_name string"),
            spark.createDataFrame([(c,) for c in catalogue], "name string"),
        ).collect()
    }
    for n in names:
        best = min((edit(n, c), c) for c in catalogue)
        assert got[n] == (best if best[0] <= 2 else (None, None))
