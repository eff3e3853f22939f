"""Daily demand series per store and product: gap-free spine, lags, rolling statistics, codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.ordering import value_codes
from stockweave.functions.scalars import calendar_parts
from stockweave.operators.features import EVENT_COLUMNS
from stockweave.params import ForecastParams
from stockweave.session import materialize

SERIES = ("store_id", "product_name")
WEATHER_COLUMNS = ("temp_max", "precipitation", "rain_bin")


def daily_demand(lines: DataFrame, order_dates: DataFrame, demographics: DataFrame) -> DataFrame:
    """Units per (order_date, store_id, product_name).

    Orders get their store first, at order grain; the lines then meet one slim order table.
    """
    placed = order_dates.select("order_id", "user_id", "order_date").join(
        demographics.select("user_id", "store_id"), "user_id"
    )
    return (
        lines.select("order_id", "product_name")
        .join(placed.drop("user_id"), "order_id")
        .groupBy("order_date", *SERIES)
        .agg(F.count("order_id").alias("units_sold"))
    )


def top_skus(daily: DataFrame, n: int) -> DataFrame:
    """Products with the largest volume; ties by name. Top-k per task, then one merge."""
    return (
        daily.groupBy("product_name")
        .agg(F.sum("units_sold").alias("volume"))
        .orderBy(F.desc("volume"), "product_name")
        .limit(n)
    )


def demand_top_skus(daily: DataFrame, n: int) -> DataFrame:
    """Demand of the top products only."""
    return daily.join(top_skus(daily, n).select("product_name"), "product_name", "left_semi")


def demand_spine(daily: DataFrame, n: int | None = None) -> DataFrame:
    """Every day of every (store, product) that occurs, days without sales filled with 0.

    With ``n``, of the top products only. The series are spread over the tasks before their days are
    made: the day range is two values, so no join builds the product.
    """
    kept = daily if n is None else demand_top_skus(daily, n)
    span = kept.agg(
        F.struct(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).alias("s")
    ).scalar()
    # A stated number, and another order of keys than the exchange below: the series are few bytes,
    # and would else be merged into one task.
    tasks = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = (
        kept.select(*SERIES)
        .distinct()
        .repartition(tasks, *reversed(SERIES))
        .withColumn("_s", span)
        .select(
            *SERIES, F.explode(F.sequence("_s.lo", "_s.hi", F.expr("interval 1 day"))).alias("order_date")
        )
    )
    return cells.join(kept, ["order_date", *SERIES], "left").select(
        "order_date", *SERIES, F.coalesce("units_sold", F.lit(0)).alias("units_sold")
    )


def with_day_context(demand: DataFrame, weather: DataFrame, events: DataFrame) -> DataFrame:
    days = weather.select("date", *WEATHER_COLUMNS).join(
        events.select("date", *EVENT_COLUMNS), "date", "full_outer"
    )
    return demand.join(days.withColumnRenamed("date", "order_date"), "order_date", "left")


def _series_window():
    return Window.partitionBy(*SERIES).orderBy("order_date")  # one row per calendar day


def demand_lags(demand: DataFrame, lags: tuple[int, ...] = (1, 7, 14, 30)) -> DataFrame:
    """Units k days ago, for days on which the longest lag exists."""
    w = _series_window()
    lagged = demand.withColumns({f"lag_{k}d": F.lag("units_sold", k).over(w) for k in lags})
    return lagged.na.drop(subset=[f"lag_{max(lags)}d"])


def demand_rolling(demand: DataFrame) -> DataFrame:
    """Mean and sample deviation of the previous 7 days, mean of the previous 30."""
    w = _series_window()
    week, month = w.rowsBetween(-7, -1), w.rowsBetween(-30, -1)
    return demand.withColumns(
        {
            "rolling_7d_mean": F.avg("units_sold").over(week),
            "rolling_7d_std": F.coalesce(F.stddev_samp("units_sold").over(week), F.lit(0.0)),
            "rolling_30d_mean": F.avg("units_sold").over(month),
        }
    )


def lag_features(demand: DataFrame, lags: tuple[int, ...] = (1, 7, 14, 30)) -> DataFrame:
    """Rolling statistics, lags and calendar parts: one shuffle and one sort by series."""
    return demand_lags(demand_rolling(demand), lags).withColumns(calendar_parts(F.col("order_date")))


def label_encode(df: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Add ``code`` per ``column`` of ``{column: code}``: 0-based place in alphabetical order.

    A null is a value of its own, named 'nan'. One job makes all code tables; they are written, so
    Spark knows their size and joins a small one without shuffling ``df``.
    """
    out = df
    labels = {c: F.coalesce(F.col(c), F.lit("nan")) for c in codes}
    table = materialize(value_codes(df.select(*[v.alias(c) for c, v in labels.items()]), list(codes)), "codes")
    for column, code in codes.items():
        own = table.filter(F.col("column") == column).select(F.col("value").alias("_label"), F.col("code").alias(code))
        out = out.withColumn("_label", labels[column]).join(own, "_label").drop("_label")
    return out


def demand_features(demand: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """All model inputs. ``demand`` carries the day context; encode a materialized frame to
    avoid running its plan once per code table."""
    return label_encode(demand, {"store_id": "store_enc", "product_name": "sku_enc", "rain_bin": "rain_enc"})


def event_uplift(demand: DataFrame, flag: str = "is_festival") -> DataFrame:
    """Mean units per product on flagged days over mean units on other days."""
    on = F.avg(F.when(F.col(flag) == 1, F.col("units_sold")))
    off = F.avg(F.when(F.coalesce(F.col(flag), F.lit(0)) == 0, F.col("units_sold")))
    return demand.groupBy("product_name").agg(
        on.alias("event_mean"), off.alias("normal_mean"), F.try_divide(on, off).alias("uplift")
    )


def demand_by_pin(lines: DataFrame, demographics: DataFrame) -> DataFrame:
    """Lines and orders per pin code; lines are counted per user before the join."""
    per_order = lines.groupBy("user_id", "order_id").agg(F.count(F.lit(1)).alias("n"))
    per_user = per_order.groupBy("user_id").agg(
        F.sum("n").alias("units"), F.count("order_id").alias("orders")
    )
    return (
        per_user.join(demographics.select("user_id", "pin_code", "store_id"), "user_id")
        .groupBy("pin_code", "store_id")
        .agg(F.sum("units").alias("units"), F.sum("orders").alias("orders"))
    )
