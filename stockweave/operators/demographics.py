"""Users and their stores, from real keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assign_stores(orders: DataFrame, areas: DataFrame) -> DataFrame:
    """(user_id, pin_code, city, store_id) of every user of ``orders``; users without an area keep
    nulls. ``areas`` has one row per user."""
    users = orders.select("user_id").distinct()
    return users.join(areas.select("user_id", "pin_code", "city", "store_id"), "user_id", "left")


def first_order_days(orders: DataFrame) -> DataFrame:
    """(user_id, first_order_date) from dated orders."""
    return orders.groupBy("user_id").agg(F.min("order_date").alias("first_order_date"))
