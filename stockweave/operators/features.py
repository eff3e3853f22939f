"""Customer features: order dates, order context, RFM and behaviour, feature store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.ordering import running_sum
from stockweave.operators.master import distinct_orders
from stockweave.params import RfmParams
from stockweave.session import materialize

WEATHER_COLUMNS = ("temp_bin", "rain_bin", "temp_max", "precipitation")
EVENT_COLUMNS = (
    "is_festival", "days_to_festival", "is_ipl_match_day", "is_exam_season", "is_monsoon", "is_weekend",
)


def assign_order_dates(master: DataFrame, first_days: DataFrame, last_day: date | None = None) -> DataFrame:
    """(order_id, user_id, order_number, order_date): the user's first day plus the days so far.

    ``first_days``: (user_id, first_order_date). Users without one get null dates; ``last_day``
    bounds the dates.
    """
    orders = materialize(  # read by the block totals and by the rows
        distinct_orders(master, ("order_id", "user_id", "order_number", "days_since_prior_order")), "orders"
    )
    gap = F.coalesce("days_since_prior_order", F.lit(0.0))
    dated = running_sum(orders, ["user_id"], "order_number", gap, "_elapsed")
    day = F.date_add("first_order_date", F.floor("_elapsed").cast("int"))
    capped = day if last_day is None else F.when(day.isNotNull(), F.least(day, F.lit(last_day)))
    return dated.join(first_days.select("user_id", "first_order_date"), "user_id", "left").select(
        "order_id", "user_id", "order_number", capped.alias("order_date")
    )


def order_context(order_dates: DataFrame, weather: DataFrame, events: DataFrame) -> DataFrame:
    """Weather and event columns of each order's day; days without an entry stay null.

    The two day tables are joined with each other first (both bounded by the calendar), so the
    order table meets one small side.
    """
    days = weather.select("date", *WEATHER_COLUMNS).join(
        events.select("date", *EVENT_COLUMNS), "date", "full_outer"
    )
    return order_dates.join(days.withColumnRenamed("date", "order_date"), "order_date", "left").select(
        *order_dates.columns, *WEATHER_COLUMNS, *EVENT_COLUMNS
    )


def user_context(context: DataFrame, rainy_above: float = 1.0) -> DataFrame:
    """Context shares per user; an order without precipitation counts as not rainy."""
    rainy = F.coalesce(F.col("precipitation") > rainy_above, F.lit(False)).cast("int")
    return context.groupBy("user_id").agg(
        F.avg("temp_max").alias("avg_temp_max"),
        F.avg(rainy).alias("pct_rainy_orders"),
        F.avg("is_festival").alias("pct_festival_orders"),
        F.avg("is_ipl_match_day").alias("pct_ipl_orders"),
        F.avg("is_monsoon").alias("pct_monsoon_orders"),
    )


def user_rfm(master: DataFrame, params: RfmParams = RfmParams()) -> DataFrame:
    """Ten features per user from two aggregations: lines to orders, orders to users.

    Line-level ratios are carried as sums, so users need no second pass over the lines.
    """
    liked = F.coalesce(F.col("product_name").rlike(f"(?i){params.affinity_pattern}"), F.lit(False))
    order_cols = ("user_id", "order_dow", "order_hour_of_day", "days_since_prior_order")
    per_order = master.groupBy("order_id").agg(
        *[F.first(c).alias(c) for c in order_cols],
        F.count("product_id").alias("basket_size"),
        F.sum("reordered").alias("reordered"),
        F.count("reordered").alias("reorder_known"),
        F.sum(liked.cast("int")).alias("liked"),
        F.count(F.lit(1)).alias("line_count"),
    )
    gap = "days_since_prior_order"
    sums = per_order.groupBy("user_id").agg(
        F.coalesce(F.sum(gap), F.lit(0.0)).alias("days_active"),
        F.count("order_id").alias("frequency"),
        F.avg("basket_size").alias("avg_basket_size"),
        F.try_divide(F.sum("reordered"), F.sum("reorder_known")).alias("reorder_ratio"),
        F.avg(F.col("order_hour_of_day").isin(*params.night_hours).cast("int")).alias("night_owl_score"),
        F.avg(F.col("order_dow").isin(*params.weekend_days).cast("int")).alias("weekend_concentration"),
        F.avg("order_hour_of_day").alias("avg_order_hour"),
        F.try_divide(F.sum("liked"), F.sum("line_count")).alias("organic_affinity"),
        F.coalesce(F.avg(gap), F.lit(0.0)).alias("avg_days_between_orders"),
    )
    # One row per user, read twice below: once for the longest history, once for the result.
    per_user = materialize(sums, "user_sums")
    longest = per_user.agg(F.max("days_active").alias("m")).scalar()
    return per_user.select(
        "user_id",
        (longest - F.col("days_active")).alias("recency"),
        "frequency",
        (F.col("avg_basket_size") * F.col("reorder_ratio")).alias("monetary_proxy"),
        "avg_basket_size",
        "reorder_ratio",
        "night_owl_score",
        "weekend_concentration",
        "avg_order_hour",
        "organic_affinity",
        "avg_days_between_orders",
    )


def feature_store(rfm: DataFrame, demographics: DataFrame, context: DataFrame) -> DataFrame:
    """RFM, demographics and context shares, one row per user."""
    return rfm.join(demographics, "user_id", "left").join(user_context(context), "user_id", "left")


def user_rfm_90d(orders: DataFrame, window_days: int = 90) -> DataFrame:
    """Calendar variant: days since the last order and orders in the trailing window,
    both seen from the last day in the data."""
    today = orders.agg(F.max("order_date").alias("d")).scalar()
    recent = F.date_diff(today, F.col("order_date")) < window_days
    return orders.groupBy("user_id").agg(
        F.date_diff(today, F.max("order_date")).alias("days_since_last_order"),
        F.count_if(recent).alias("orders_90d"),
    )
