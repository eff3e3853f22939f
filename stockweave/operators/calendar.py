"""Calendar spine and the event calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.scalars import calendar_flags, calendar_parts, event_context
from stockweave.params import CalendarParams


def day_spine(df: DataFrame, day: Column) -> DataFrame:
    """Every day between the smallest and the largest ``day`` in ``df``."""
    return df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date")
    )


def event_calendar(days: DataFrame, params: CalendarParams = CalendarParams()) -> DataFrame:
    """Flags per day. Festivals and windows are parameters: a projection, no range join."""
    flags = calendar_flags(F.col("date"), params)
    return days.select("date", *[c.alias(name) for name, c in flags.items()])


def event_calendar_summary(calendar: DataFrame) -> DataFrame:
    """Days per flag, and their orders where the calendar has a column ``orders``."""
    sums = {"festival": F.col("is_festival"), "season": F.col("is_ipl_match_day")}
    days = [F.sum(c).alias(f"{name}_days") for name, c in sums.items()]
    orders = [F.sum(c * F.col("orders")).alias(f"{name}_orders") for name, c in sums.items()]
    return calendar.agg(F.count(F.lit(1)).alias("calendar_days"), *days, *(orders if "orders" in calendar.columns else []))


def with_calendar_parts(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(calendar_parts(F.col(day)))


def latest_event_context(calendar: DataFrame) -> DataFrame:
    """One row: the last calendar day, its days to the next festival and its context label."""
    last = calendar.agg(
        F.max_by(F.struct("date", "days_to_festival", "is_festival", "is_ipl_match_day", "is_monsoon"), "date").alias("e")
    )
    return last.select(
        F.col("e.date").alias("date"),
        F.col("e.days_to_festival").alias("days_to_festival"),
        event_context(F.col("e.is_festival"), F.col("e.is_ipl_match_day"), F.col("e.is_monsoon")).alias("event_context"),
    )
