"""Replenishment list: forecast, stock, segments, rules and calendar brought together."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.scalars import (
    event_context,
    half_even_int,
    urgency_color,
    urgency_label,
    urgency_level,
)
from stockweave.operators.calendar import latest_event_context
from stockweave.operators.demand import SERIES
from stockweave.operators.rules import best_rule_per_item
from stockweave.params import FusionParams


def latest_forecast(forecasts: DataFrame) -> DataFrame:
    """Newest forecast row per series: an aggregate, combined per map task."""
    rest = [c for c in forecasts.columns if c not in SERIES]
    newest = forecasts.groupBy(*SERIES).agg(F.max_by(F.struct(*rest), "order_date").alias("r"))
    return newest.select(*SERIES, "r.*")


def current_stock(forecasts: DataFrame, p: FusionParams = FusionParams()) -> DataFrame:
    """Stock estimate: a share of the mean positive demand. Series that never sold drop out."""
    mean = forecasts.filter("units_sold > 0").groupBy(*SERIES).agg(F.avg("units_sold").alias("mean"))
    return mean.select(*SERIES, half_even_int(F.col("mean") * F.lit(p.stock_factor)).alias("current_stock"))


def dominant_segment(segments: DataFrame, demographics: DataFrame) -> DataFrame:
    """Most common segment per store; ties by name."""
    counts = (
        demographics.select("user_id", "store_id")
        .join(segments.select("user_id", "cluster_name"), "user_id")
        .groupBy("store_id", "cluster_name")
        .agg(F.count("user_id").alias("n"))
    )
    top = F.min_by("cluster_name", F.struct(-F.col("n"), F.col("cluster_name")))
    return counts.groupBy("store_id").agg(top.alias("dominant_segment"))


def score_actions(actions: DataFrame, p: FusionParams = FusionParams()) -> DataFrame:
    """Urgency 1-5 with label and colour."""
    level = urgency_level(F.col("forecast_units"), F.col("current_stock"), F.col("days_to_festival"), p)
    return actions.withColumn("urgency", level).withColumns(
        {"urgency_label": urgency_label(F.col("urgency")), "urgency_color": urgency_color(F.col("urgency"))}
    )


def attach_bundles(actions: DataFrame, rules: DataFrame, segment_first: bool = False) -> DataFrame:
    """Add bundle_with and bundle_lift: the strongest rule whose only antecedent is the product.

    ``segment_first`` prefers a rule of the store's dominant segment.
    """
    best = best_rule_per_item(rules).withColumnsRenamed(
        {"antecedent": "product_name", "consequent": "bundle_with", "lift": "bundle_lift"}
    )
    if not segment_first:
        return actions.join(best, "product_name", "left")
    own = best_rule_per_item(rules, ("segment",)).withColumnsRenamed(
        {"segment": "dominant_segment", "antecedent": "product_name", "consequent": "_with", "lift": "_lift"}
    )
    return (
        actions.join(own, ["dominant_segment", "product_name"], "left")
        .join(best, "product_name", "left")
        .withColumn("bundle_lift", F.coalesce("_lift", "bundle_lift"))
        .withColumn("bundle_with", F.coalesce("_with", "bundle_with"))
        .drop("_with", "_lift")
    )


def attach_event_context(actions: DataFrame, calendar: DataFrame, mode: str) -> DataFrame:
    """'calendar_end': the last calendar day for all; 'as_of': the day of each forecast."""
    if mode == "calendar_end":
        last = latest_event_context(calendar).select(F.struct("days_to_festival", "event_context").alias("e"))
        return actions.withColumn("_e", last.scalar()).select(*actions.columns, "_e.*")
    if mode != "as_of":
        raise ValueError(f"unknown event mode: {mode}")
    label = event_context(F.col("is_festival"), F.col("is_ipl_match_day"), F.col("is_monsoon"))
    days = calendar.select(F.col("date").alias("order_date"), "days_to_festival", label.alias("event_context"))
    return actions.join(days, "order_date", "left")


def build_action_list(
    forecasts: DataFrame,
    stock: DataFrame,
    dominant: DataFrame,
    rules: DataFrame,
    calendar: DataFrame,
    generated_at: datetime,
    p: FusionParams = FusionParams(),
) -> DataFrame:
    """One action per series, without a final order (see ``ranked``)."""
    actions = (
        latest_forecast(forecasts)
        .join(stock, list(SERIES))
        .join(dominant, "store_id", "left")
        .withColumn(
            "reorder_qty", F.greatest(F.col("forecast_units") - F.col("current_stock"), F.lit(0)).cast("int")
        )
    )
    scored = score_actions(attach_event_context(actions, calendar, p.event_mode), p)
    return (
        attach_bundles(scored, rules)
        .withColumn("generated_at", F.date_trunc("hour", F.lit(generated_at)))
        .select(*p.columns)
    )


def ranked(actions: DataFrame) -> DataFrame:
    """Store, most urgent first, largest reorder first, product name as the last word."""
    return actions.orderBy("store_id", F.desc("urgency"), F.desc("reorder_qty"), "product_name")


def urgency_distribution(actions: DataFrame) -> DataFrame:
    return actions.groupBy("urgency_label", "urgency").agg(F.count(F.lit(1)).alias("n"))


def bundle_coverage(actions: DataFrame) -> DataFrame:
    with_bundle = F.count("bundle_with")
    return actions.agg(
        F.count(F.lit(1)).alias("actions"),
        with_bundle.alias("with_bundle"),
        F.max("bundle_lift").alias("top_lift"),
    )


def most_urgent(actions: DataFrame, level: int = 5, n: int = 5) -> DataFrame:
    return (
        actions.filter(F.col("urgency") == level)
        .orderBy(F.desc("reorder_qty"), "store_id", "product_name")
        .limit(n)
        .select(
            "store_id", "product_name", "forecast_units", "current_stock", "reorder_qty",
            "urgency_label", "bundle_with",
        )
    )


def store_kpis(actions: DataFrame, alert_level: int = 4) -> DataFrame:
    """Per store: products, products at risk of running out, alerts, units to reorder."""
    at_risk = F.col("forecast_units") > F.col("current_stock")
    return actions.groupBy("store_id").agg(
        F.count("product_name").alias("skus"),
        F.count_if(at_risk).alias("stockout_risk"),
        F.count_if(F.col("urgency") >= alert_level).alias("alerts"),
        F.sum("reorder_qty").alias("units_to_reorder"),
    )


def store_actions_top(actions: DataFrame, n: int = 50) -> DataFrame:
    """The n most urgent actions of each store."""
    w = Window.partitionBy("store_id").orderBy(F.desc("urgency"), F.desc("reorder_qty"), "product_name")
    return actions.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def backtest(
    demand: DataFrame,
    forecast: Column,
    unit_values: DataFrame,
    days: int = 30,
    p: FusionParams = FusionParams(),
) -> DataFrame:
    """Hold-out check over the last ``days``: stock comes from the history before, the
    recommendation of one day meets the demand of the next.

    Per store: stock-outs without the recommendation, those it avoids, overstock (stock plus
    order more than twice the demand), and the avoided ones times the product's ``unit_value``.
    """
    last = demand.agg(F.max("order_date").alias("d")).scalar()
    start = F.date_sub(last, days - 1)
    stock = current_stock(demand.filter(F.col("order_date") < start), p)
    held = (
        demand.filter(F.col("order_date") >= start)
        .select(*SERIES, "order_date", "units_sold", half_even_int(F.greatest(forecast, F.lit(0.0))).alias("forecast_units"))
    )
    next_day = held.select(*SERIES, F.date_sub("order_date", 1).alias("order_date"), F.col("units_sold").alias("demand"))
    supply = F.col("current_stock") + F.greatest(F.col("forecast_units") - F.col("current_stock"), F.lit(0))
    short = F.col("demand") > F.col("current_stock")
    per_series = (
        held.join(next_day, [*SERIES, "order_date"])
        .join(stock, list(SERIES))
        .withColumn("supply", supply)
        .groupBy(*SERIES)
        .agg(
            F.count(F.lit(1)).alias("checked"),
            F.count_if(short).alias("stockouts"),
            F.count_if(short & (F.col("demand") <= F.col("supply"))).alias("avoided_stockouts"),
            F.count_if((F.col("demand") > 0) & (F.col("supply") > 2 * F.col("demand"))).alias("overstocks"),
        )
    )
    sums = ("checked", "stockouts", "avoided_stockouts", "overstocks")
    value = F.col("avoided_stockouts") * F.coalesce("unit_value", F.lit(0.0))
    return (
        per_series.join(unit_values, "product_name", "left")
        .groupBy("store_id")
        .agg(*[F.sum(c).alias(c) for c in sums], F.sum(value).alias("avoided_value"))
    )


def actual_vs_forecast(forecasts: DataFrame, product: str | Column) -> DataFrame:
    """One product's daily actual and forecast units per store."""
    return forecasts.filter(F.col("product_name") == product).select(
        "store_id", "order_date", "units_sold", "forecast_units"
    )
