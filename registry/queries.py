"""One query per operator: the operator applied to the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.operators import (
    baskets,
    calendar,
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
    timejoins,
)
from stockweave.functions.scalars import calendar_parts, days_to_next, rain_bin, temp_bin, time_slot
from stockweave.params import CLUSTER_FEATURES, ForecastParams, FusionParams, MiningParams, RfmParams, SegmentParams
from registry import weather_input
from registry.scratch import local_scratch
from stockweave.session import materialize, scratch_path, tune
from stockweave.sources import adapter, raw, weather

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RFM = RfmParams(affinity_pattern="red")
MINING = MiningParams(min_orders=100)
CAPPED = replace(MINING, max_orders=150, top_items=50)
FORECAST = ForecastParams()
GENERATED_AT = datetime(2001, 8, 1, 9, 30)
FESTIVAL_DAY = date(1999, 10, 20)
LAST_DAY = date(2001, 6, 30)


def query(name: str):
    def keep(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(local_scratch(tune(spark)), sf_dir)

        REGISTRY[name] = run
        return fn

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that engines with another order of summation compare equal."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# ---- shared inputs ---------------------------------------------------------


def order_heads(spark: SparkSession, d: str) -> DataFrame:
    """Orders of the master table that have lines."""
    heads = adapter.orders(spark, d).filter(F.col("eval_set") == "prior")
    return heads.join(adapter.order_products(spark, d), "order_id", "left_semi")


def context(spark: SparkSession, d: str) -> DataFrame:
    dates = order_heads(spark, d).select("order_id", "user_id", "order_date")
    return features.order_context(dates, weather_input.weather(spark, d), adapter.calendar(spark, d))


def dated_orders(spark: SparkSession, d: str) -> DataFrame:
    heads = adapter.orders(spark, d).filter(F.col("eval_set") == "prior")
    return heads.select("order_id", "user_id", "order_date")


def enriched(spark: SparkSession, d: str, item: str = "product_name") -> DataFrame:
    """Basket lines with their context; ``item`` is the master column mined as product."""
    lines = adapter.sales(spark, d, ["order_id", "order_hour_of_day", item]).withColumnRenamed(
        item, "product_name"
    )
    days = weather_input.weather(spark, d).select(F.col("date").alias("order_date"), "rain_bin")
    when = dated_orders(spark, d).join(days, "order_date", "left")
    return baskets.enrich_baskets(lines, when, adapter.segments(spark, d))


def daily(spark: SparkSession, d: str) -> DataFrame:
    """The dated orders are those of the master table, so they filter the lines by themselves."""
    lines = adapter.product_lines(spark, d)
    return demand.daily_demand(lines, dated_orders(spark, d), adapter.demographics(spark, d))


def spine(spark: SparkSession, d: str) -> DataFrame:
    """Daily series of all products; the aggregated demand is written once and read twice."""
    return demand.demand_spine(materialize(daily(spark, d), "daily_demand"), FORECAST.top_skus)


def model_rows(spark: SparkSession, d: str) -> DataFrame:
    """All model inputs, materialized."""
    rows = demand.lag_features(
        demand.with_day_context(spine(spark, d), weather_input.weather(spark, d), adapter.calendar(spark, d))
    )
    return demand.demand_features(materialize(rows, "lagged_demand"), FORECAST)


def lagged(spark: SparkSession, d: str) -> DataFrame:
    return demand.demand_lags(spine(spark, d))


def naive_forecasts(spark: SparkSession, d: str) -> DataFrame:
    rows = lagged(spark, d)
    return forecast.as_forecast(rows, forecast.naive_prediction(), "seasonal_naive", F.lit(None).cast("double"))


def user_features(spark: SparkSession, d: str) -> DataFrame:
    lines = adapter.sales(
        spark, d,
        ["order_id", "user_id", "order_dow", "order_hour_of_day", "days_since_prior_order",
         "product_id", "product_name", "reordered"],
    )
    rfm = features.user_rfm(lines, RFM)
    return features.feature_store(rfm, adapter.demographics(spark, d), context(spark, d))


def cluster_input(spark: SparkSession, d: str) -> DataFrame:
    return materialize(user_features(spark, d).select("user_id", *CLUSTER_FEATURES), "user_features")


def labelled(spark: SparkSession, d: str, scaled: bool = True) -> DataFrame:
    """Scaled user features with the given market segment as label."""
    rows = cluster_input(spark, d)
    if scaled:
        rows = materialize(segments.scaled_features(rows), "scaled")
    return rows.join(adapter.segments(spark, d), "user_id")


def mined(spark: SparkSession, d: str) -> DataFrame:
    return rules.context_rules(enriched(spark, d, "department"), MINING)


def product_rules(spark: SparkSession, d: str) -> DataFrame:
    return rules.context_rules(enriched(spark, d), MINING)


def plain(rule_table: DataFrame) -> DataFrame:
    return rounded(rule_table.drop("antecedents", "consequents"))


def actions(spark: SparkSession, d: str, until: date | None = None, p: FusionParams = FusionParams()) -> DataFrame:
    """The list from all forecasts, or from those up to a day."""
    forecasts = materialize(naive_forecasts(spark, d), "forecasts")
    known = forecasts if until is None else forecasts.filter(F.col("order_date") <= F.lit(until))
    return fusion.build_action_list(
        known,
        fusion.current_stock(known),
        fusion.dominant_segment(adapter.segments(spark, d), adapter.demographics(spark, d)),
        product_rules(spark, d),
        adapter.calendar(spark, d),
        GENERATED_AT,
        p,
    )


def festival_actions(spark: SparkSession, d: str) -> DataFrame:
    """The list as of a festival day, each action in the context of its own day."""
    return actions(spark, d, FESTIVAL_DAY, FusionParams(event_mode="as_of"))


# ---- scans, sources, sinks -------------------------------------------------


@query("scan_csv_roundtrip")
def _(spark, d):
    path = scratch_path(spark, "raw")
    tables = adapter.raw_tables(spark, d)
    for name, file in raw.RAW_FILES.items():
        raw.write_csv(tables[name], f"{path}/{file}")
    return master.build_master(**raw.load_raw(spark, path))


@query("scan_csv_pruned")
def _(spark, d):
    path = raw.write_csv(adapter.raw_tables(spark, d)["orders"], scratch_path(spark, "orders_csv"))
    users = raw.read_csv(spark, path, raw.RAW_SCHEMAS["orders"]).select("user_id")
    return users.groupBy("user_id").agg(F.count(F.lit(1)).alias("orders"))


@query("scan_parquet")
def _(spark, d):
    return adapter.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


@query("sink_parquet_roundtrip")
def _(spark, d):
    path = raw.write_parquet(daily(spark, d), scratch_path(spark, "demand"), ("store_id",))
    return spark.read.parquet(path).select("order_date", "store_id", "product_name", "units_sold")


@query("weather_json_explode")
def _(spark, d):
    path = weather_input.land_json(weather_input.event_readings(spark, d), scratch_path(spark, "weather_json"))
    return weather.read_weather_json(spark, path)


@query("calendar_spine")
def _(spark, d):
    per_day = adapter.orders(spark, d).groupBy(F.col("order_date").alias("date")).agg(
        F.count("order_id").alias("n")
    )
    days = adapter.order_days(spark, d)
    return days.join(per_day, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("orders"))


# ---- master, dimensions, calendar ------------------------------------------


@query("product_dim")
def _(spark, d):
    return master.product_dim(adapter.products(spark, d), adapter.aisles(spark, d), adapter.departments(spark, d))


@query("master_transactions")
def _(spark, d):
    return master.build_master(**adapter.raw_tables(spark, d))


@query("orders_distinct")
def _(spark, d):
    return master.distinct_orders(adapter.sales(spark, d, master.ORDER_COLUMNS))


@query("store_assignment")
def _(spark, d):
    return demographics.assign_stores(adapter.orders(spark, d), adapter.demographics(spark, d))


def calendar_orders(spark: SparkSession, d: str) -> DataFrame:
    """The event calendar with the number of orders of each day."""
    per_day = adapter.orders(spark, d).groupBy(F.col("order_date").alias("date")).agg(F.count("order_id").alias("orders"))
    return adapter.calendar(spark, d).join(per_day, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("event_calendar")
def _(spark, d):
    return calendar_orders(spark, d)


@query("event_calendar_summary")
def _(spark, d):
    return calendar.event_calendar_summary(calendar_orders(spark, d))


@query("days_to_festival")
def _(spark, d):
    gap = days_to_next(F.col("order_date"), adapter.CALENDAR.festivals, adapter.CALENDAR.max_days_ahead)
    return adapter.orders(spark, d).select("order_id", "order_date", gap.alias("days_to_festival"))


@query("calendar_parts")
def _(spark, d):
    parts = calendar_parts(F.col("order_date"))
    return adapter.orders(spark, d).select("order_id", "order_date", *[c.alias(n) for n, c in parts.items()])


@query("weather_bins")
def _(spark, d):
    rows = dated_orders(spark, d).select("order_id", F.col("order_date").alias("date"))
    return weather_input.weather_values(rows.select("date").distinct()).join(rows, "date").select(
        "order_id", "temp_max", "precipitation",
        temp_bin(F.col("temp_max")).alias("temp_bin"), rain_bin(F.col("precipitation")).alias("rain_bin"),
    )


@query("time_slots")
def _(spark, d):
    return adapter.orders(spark, d).select(
        "order_id", "order_hour_of_day", time_slot(F.col("order_hour_of_day")).alias("time_slot")
    )


@query("latest_event_context")
def _(spark, d):
    return calendar.latest_event_context(adapter.calendar(spark, d))


# ---- joins by time ---------------------------------------------------------


def customer_orders(spark: SparkSession, d: str) -> DataFrame:
    return adapter.table(spark, d, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ordered"), F.col("o_orderkey").alias("order_id")
    )


def with_met_order(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, F.col("met.ordered").alias("ordered"), F.col("met.order_id").alias("met_order"))


@query("asof_next_order")
def _(spark, d):
    """The events' year is moved back into the orders' years."""
    events = adapter.table(spark, d, "events").select(
        "event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 25 YEARS")).alias("at")
    )
    met = timejoins.asof_join(events, customer_orders(spark, d), ["user_id"], "at", "ordered", "met")
    return with_met_order(met, "event_id", "user_id")


@query("asof_order_before_shipping")
def _(spark, d):
    """For every line the customer's last order at or before the day it was shipped."""
    lines = adapter.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("shipped")
    )
    owners = customer_orders(spark, d).select("user_id", F.col("order_id").alias("order_key"))
    met = timejoins.asof_join(
        lines.join(owners, "order_key"), customer_orders(spark, d), ["user_id"], "shipped", "ordered", "met", forward=False
    )
    return with_met_order(met, "order_key", "line", "user_id")


@query("interval_supplier_load")
def _(spark, d):
    """Lines and units a supplier ships while a returned line is made good, a day for each of its units."""
    lines = adapter.table(spark, d, "lineitem")
    windows = lines.filter("l_returnflag = 'R'").select(
        "l_suppkey", F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").cast("date").alias("first_day"),
        F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")).alias("last_day"),
    )
    shipped = lines.select("l_suppkey", F.col("l_shipdate").cast("date").alias("day"), "l_quantity")
    met = timejoins.interval_join(shipped, windows, ["l_suppkey"], "day", "first_day", "last_day")
    return met.groupBy("order_key", "line", "first_day", "last_day").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("units")
    )


# ---- features --------------------------------------------------------------


@query("order_dates")
def _(spark, d):
    cols = ["order_id", "user_id", "order_number", "days_since_prior_order"]
    first = demographics.first_order_days(adapter.orders(spark, d))
    return features.assign_order_dates(adapter.sales(spark, d, cols), first, LAST_DAY)


@query("order_context")
def _(spark, d):
    return context(spark, d)


@query("user_rfm")
def _(spark, d):
    cols = ["order_id", "user_id", "order_dow", "order_hour_of_day", "days_since_prior_order",
            "product_id", "product_name", "reordered"]
    return rounded(features.user_rfm(adapter.sales(spark, d, cols), RFM))


@query("user_context")
def _(spark, d):
    return rounded(features.user_context(context(spark, d)))


@query("feature_store")
def _(spark, d):
    return rounded(user_features(spark, d))


@query("user_rfm_90d")
def _(spark, d):
    return features.user_rfm_90d(dated_orders(spark, d))


# ---- profile ---------------------------------------------------------------


@query("distinct_counts")
def _(spark, d):
    cols = ["user_id", "order_id", "product_id"]
    return profile.distinct_counts(adapter.sales(spark, d, cols), cols)


@query("value_counts")
def _(spark, d):
    return profile.value_counts(adapter.demographics(spark, d), "store_id")


@query("value_counts_rain")
def _(spark, d):
    return profile.value_counts(context(spark, d), "rain_bin")


@query("value_counts_product")
def _(spark, d):
    return profile.value_counts(adapter.sales(spark, d, ["product_name"]), "product_name")


@query("null_profile")
def _(spark, d):
    return profile.null_profile(adapter.sales(spark, d, master.MASTER_COLUMNS))


@query("orders_by_dow")
def _(spark, d):
    return profile.orders_by(order_heads(spark, d), "order_dow", profile.DAY_NAMES)


@query("orders_by_hour")
def _(spark, d):
    return profile.orders_by(order_heads(spark, d), "order_hour_of_day")


@query("top_products")
def _(spark, d):
    return profile.top_products(adapter.sales(spark, d, ["product_name"]), 50)


@query("basket_size_stats")
def _(spark, d):
    sizes = profile.basket_sizes(adapter.sales(spark, d, ["order_id", "product_id"]))
    return rounded(profile.describe(sizes, "basket_size"))


@query("hist_basket_size")
def _(spark, d):
    sizes = profile.basket_sizes(adapter.sales(spark, d, ["order_id", "product_id"]))
    return profile.histogram(sizes, "basket_size", 50, 1, 60)


@query("hist_gap_days")
def _(spark, d):
    orders = master.distinct_orders(
        adapter.sales(spark, d, ["order_id", "days_since_prior_order"]), ("order_id", "days_since_prior_order")
    )
    return profile.histogram(orders, "days_since_prior_order", 30)


@query("gap_peaks")
def _(spark, d):
    orders = master.distinct_orders(
        adapter.sales(spark, d, ["order_id", "days_since_prior_order"]), ("order_id", "days_since_prior_order")
    )
    return profile.gap_peaks(orders)


@query("hist_reorder_rate")
def _(spark, d):
    rates = profile.user_reorder_rates(adapter.sales(spark, d, ["user_id", "reordered"]))
    return profile.histogram(rates, "reorder_rate", 40)


@query("reorder_rate_stats")
def _(spark, d):
    rates = profile.user_reorder_rates(adapter.sales(spark, d, ["user_id", "reordered"]))
    return rounded(profile.describe(rates, "reorder_rate"))


@query("dept_hour_heatmap")
def _(spark, d):
    return rounded(profile.dept_hour_heatmap(adapter.sales(spark, d, ["department", "order_hour_of_day"])))


@query("copurchase_corr")
def _(spark, d):
    return rounded(profile.copurchase_corr(adapter.sales(spark, d, ["order_id", "product_name"]), 30))


# ---- demand ----------------------------------------------------------------


@query("daily_demand")
def _(spark, d):
    return daily(spark, d)


@query("demand_top_skus")
def _(spark, d):
    return demand.demand_top_skus(materialize(daily(spark, d), "daily_demand"), 50)


@query("demand_spine")
def _(spark, d):
    return spine(spark, d)


@query("demand_lags")
def _(spark, d):
    return lagged(spark, d)


@query("demand_rolling")
def _(spark, d):
    return rounded(demand.demand_rolling(spine(spark, d)))


@query("label_encode")
def _(spark, d):
    rows = materialize(daily(spark, d), "daily_demand")
    return demand.label_encode(rows, {"store_id": "store_enc", "product_name": "sku_enc"})


@query("demand_features")
def _(spark, d):
    return rounded(model_rows(spark, d))


@query("event_uplift")
def _(spark, d):
    rows = demand.with_day_context(spine(spark, d), weather_input.weather(spark, d), adapter.calendar(spark, d))
    return rounded(demand.event_uplift(rows))


@query("demand_by_pin")
def _(spark, d):
    return demand.demand_by_pin(adapter.sales(spark, d, ["order_id", "user_id"]), adapter.demographics(spark, d))


# ---- forecast --------------------------------------------------------------


@query("time_series_folds")
def _(spark, d):
    rows = forecast.time_series_folds(materialize(lagged(spark, d), "lagged"), FORECAST)
    return rows.select("order_date", "store_id", "product_name", "units_sold", "position", "test_fold")


@query("naive_baseline")
def _(spark, d):
    return rounded(forecast.naive_baseline(forecast.time_series_folds(materialize(lagged(spark, d), "lagged"), FORECAST)))


@query("forecast_accuracy")
def _(spark, d):
    rows = materialize(demand.lag_features(spine(spark, d)), "lagged")
    folds = forecast.time_series_folds(rows, FORECAST)
    return rounded(forecast.forecast_accuracy(folds, F.col("rolling_30d_mean")))


@query("forecast_hit_rate")
def _(spark, d):
    rows = materialize(demand.lag_features(spine(spark, d)), "lagged")
    folds = materialize(forecast.time_series_folds(rows, FORECAST), "folds")
    return rounded(forecast.forecast_hit_rate(folds, F.col("rolling_30d_mean")))


@query("interval_hit_rate")
def _(spark, d):
    rows = materialize(demand.lag_features(spine(spark, d)), "lagged")
    folds = materialize(forecast.time_series_folds(rows, FORECAST), "folds")
    return rounded(forecast.interval_hit_rate(folds, F.col("rolling_30d_mean")))


@query("gbt_forecast")
def _(spark, d):
    rows = materialize(model_rows(spark, d), "model_rows")
    return forecast.boosted_forecast(rows, forecast.fit_boosted(rows, FORECAST), FORECAST)


@query("gbt_fold_report")
def _(spark, d):
    rows = materialize(model_rows(spark, d), "model_rows")
    return forecast.fold_report(forecast.fit_boosted(rows, FORECAST))


@query("feature_importance")
def _(spark, d):
    rows = materialize(model_rows(spark, d), "model_rows")
    return forecast.feature_importance(forecast.fit_boosted(rows, FORECAST), FORECAST)


@query("feature_attribution")
def _(spark, d):
    rows = materialize(model_rows(spark, d), "model_rows")
    return forecast.feature_attribution(forecast.fit_boosted(rows, FORECAST))


# ---- baskets and rules -----------------------------------------------------


@query("basket_enriched")
def _(spark, d):
    return enriched(spark, d)


@query("slice_order_counts")
def _(spark, d):
    return baskets.slice_order_counts(enriched(spark, d), MINING)


@query("slice_order_cap")
def _(spark, d):
    return baskets.slice_order_cap(enriched(spark, d), CAPPED)


@query("slice_top_items")
def _(spark, d):
    rows = enriched(spark, d)
    present = baskets.presence(rows.select(*MINING.slice_cols, "order_id", F.col("product_name").alias("item")))
    used = present.join(baskets.slice_order_cap(rows, CAPPED), [*MINING.slice_cols, "order_id"])
    return baskets.slice_top_items(baskets.slice_item_counts(used, CAPPED), CAPPED)


@query("context_itemsets")
def _(spark, d):
    return rounded(baskets.context_itemsets(enriched(spark, d, "department"), MINING).drop("items"))


@query("context_rules")
def _(spark, d):
    return plain(mined(spark, d))


@query("rules_summary")
def _(spark, d):
    return rounded(rules.rules_summary(mined(spark, d)))


@query("top_rules")
def _(spark, d):
    return plain(rules.top_rules(mined(spark, d), MINING))


@query("top_rules_per_segment")
def _(spark, d):
    return plain(rules.top_rules_per_segment(mined(spark, d), MINING))


@query("best_rule_per_item")
def _(spark, d):
    return rounded(rules.best_rule_per_item(mined(spark, d)))


@query("rule_coverage")
def _(spark, d):
    rows = enriched(spark, d)
    start = baskets.slice_baskets(rows, MINING)
    return rounded(rules.rule_coverage(start, rules.rules_from(start, MINING), MINING))


@query("lift_gain")
def _(spark, d):
    rows = materialize(enriched(spark, d, "department"), "enriched")
    everywhere = rules.global_rules(rows, replace(MINING, min_lift=0.0, min_confidence=0.0))
    local = rules.context_rules(rows, MINING)
    return rounded(rules.lift_gain(local, everywhere, MINING))


@query("segment_top_products")
def _(spark, d):
    return rules.segment_top_products(enriched(spark, d))


@query("segment_affinity")
def _(spark, d):
    return rounded(rules.segment_affinity(enriched(spark, d)))


@query("fuzzy_product_match")
def _(spark, d):
    part = adapter.table(spark, d, "part")
    external = part.select(F.translate("p_name", "eo", "ai").alias("name"), F.col("p_type").alias("category"))
    catalogue = external.groupBy("name").agg(F.min("category").alias("category"))
    return matching.fuzzy_product_match(part.select(F.col("p_name").alias("product_name")), catalogue)


# ---- segmentation ----------------------------------------------------------

SEGMENT = SegmentParams()


def outliers(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """The given segments, density outliers as a cluster of their own."""
    scaled = materialize(segments.scaled_features(rows), "scaled")
    noise = density.density_noise(scaled, CLUSTER_FEATURES, "user_id", SEGMENT.eps, SEGMENT.min_samples)
    given = adapter.segments(spark, d).select("user_id", "cluster_id")
    return materialize(segments.outlier_labels(given, noise), "outlier_labels")


@query("feature_medians")
def _(spark, d):
    return rounded(segments.feature_medians(cluster_input(spark, d), CLUSTER_FEATURES))


@query("scaled_features")
def _(spark, d):
    return rounded(segments.scaled_features(cluster_input(spark, d)))


@query("cluster_profile")
def _(spark, d):
    return rounded(segments.cluster_profile(labelled(spark, d, scaled=False), CLUSTER_FEATURES))


@query("persona_names")
def _(spark, d):
    rows = segments.cluster_profile(labelled(spark, d, scaled=False), CLUSTER_FEATURES)
    return segments.persona_names(materialize(rows, "profile"))


@query("persona_names_with_outliers")
def _(spark, d):
    rows = cluster_input(spark, d)
    marked = outliers(spark, d, rows)
    profile_rows = segments.cluster_profile(rows.join(marked, "user_id"), CLUSTER_FEATURES)
    power = marked.agg(F.max("power_label").alias("m")).scalar()
    return segments.persona_names(materialize(profile_rows, "profile"), power)


@query("outlier_labels")
def _(spark, d):
    return outliers(spark, d, cluster_input(spark, d))


@query("silhouette")
def _(spark, d):
    return rounded(segments.silhouette(labelled(spark, d), CLUSTER_FEATURES, "cluster_id"))


@query("sampled_silhouette")
def _(spark, d):
    """The sample is the operator's own; the twin holds while all users fit in it."""
    return rounded(segments.sampled_silhouette(labelled(spark, d), CLUSTER_FEATURES, "cluster_id", "user_id"))


@query("davies_bouldin")
def _(spark, d):
    return rounded(segments.davies_bouldin(labelled(spark, d), CLUSTER_FEATURES, "cluster_id"))


@query("density_outliers")
def _(spark, d):
    scaled = materialize(segments.scaled_features(cluster_input(spark, d)), "scaled")
    return density.density_noise(scaled, CLUSTER_FEATURES, "user_id", SEGMENT.eps, SEGMENT.min_samples)


@query("kmeans_segments")
def _(spark, d):
    scaled = materialize(segments.scaled_features(cluster_input(spark, d)), "scaled")
    return segments.kmeans_segments(scaled, 4, SEGMENT)


@query("k_selection")
def _(spark, d):
    scaled = materialize(segments.scaled_features(cluster_input(spark, d)), "scaled")
    return segments.k_selection(scaled, SEGMENT)


@query("segment_labels")
def _(spark, d):
    return segments.segment_labels(cluster_input(spark, d), 4, SEGMENT)


@query("pca_projection")
def _(spark, d):
    rows = labelled(spark, d)
    return segments.pca_projection(rows.drop("cluster_id", "cluster_name"), rows.select("user_id", "cluster_id"))


# ---- fusion ----------------------------------------------------------------


@query("latest_forecast")
def _(spark, d):
    return fusion.latest_forecast(naive_forecasts(spark, d).drop("mape"))


@query("current_stock")
def _(spark, d):
    return fusion.current_stock(naive_forecasts(spark, d))


@query("dominant_segment")
def _(spark, d):
    return fusion.dominant_segment(adapter.segments(spark, d), adapter.demographics(spark, d))


@query("urgency_scores")
def _(spark, d):
    forecasts = materialize(naive_forecasts(spark, d), "forecasts")
    days = adapter.calendar(spark, d).select(F.col("date").alias("order_date"), "days_to_festival")
    rows = forecasts.filter("units_sold > 0").join(fusion.current_stock(forecasts), ["store_id", "product_name"])
    return fusion.score_actions(rows.join(days, "order_date")).drop("model_type", "mape")


@query("attach_bundles")
def _(spark, d):
    items = adapter.sales(spark, d, ["product_name"]).distinct()
    return rounded(fusion.attach_bundles(items, product_rules(spark, d)))


@query("attach_bundles_by_segment")
def _(spark, d):
    stores = fusion.dominant_segment(adapter.segments(spark, d), adapter.demographics(spark, d))
    items = daily(spark, d).select("store_id", "product_name").distinct().join(stores, "store_id")
    return rounded(fusion.attach_bundles(items, product_rules(spark, d), segment_first=True))


@query("action_list")
def action_list(spark, d):
    return fusion.ranked(rounded(actions(spark, d)))


@query("action_list_as_of")
def _(spark, d):
    return fusion.ranked(rounded(festival_actions(spark, d)))


@query("urgency_distribution")
def _(spark, d):
    return fusion.urgency_distribution(actions(spark, d))


@query("bundle_coverage")
def _(spark, d):
    return rounded(fusion.bundle_coverage(actions(spark, d)))


@query("critical_actions")
def _(spark, d):
    return fusion.most_urgent(festival_actions(spark, d))


@query("store_kpis")
def _(spark, d):
    return fusion.store_kpis(actions(spark, d))


@query("store_actions_top")
def _(spark, d):
    return rounded(fusion.store_actions_top(actions(spark, d), 50))


@query("backtest_30d")
def _(spark, d):
    price = adapter.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") * 100).cast("long").alias("cents")
    )
    names = adapter.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("product_name"))
    per_part = price.groupBy("p_partkey").agg(F.sum("cents").alias("c"), F.count("cents").alias("n"))
    values = per_part.join(names, "p_partkey").groupBy("product_name").agg(
        (F.sum("c") / F.sum("n") / 100).alias("unit_value")
    )
    return rounded(fusion.backtest(materialize(lagged(spark, d), "lagged"), forecast.naive_prediction(), values), 4)


@query("sku_actual_vs_forecast")
def _(spark, d):
    forecasts = materialize(naive_forecasts(spark, d), "forecasts")
    best = demand.top_skus(forecasts.select("product_name", "units_sold"), 1).select("product_name").scalar()
    return fusion.actual_vs_forecast(forecasts, best)
