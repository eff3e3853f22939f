"""Weather for the test tables, which have none: by arithmetic on the day, or the events table as
landed JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.sources import adapter
from stockweave.sources.weather import with_weather_bins


def weather_values(days: DataFrame) -> DataFrame:
    """Weather of a day by integer arithmetic on the day of the year, with some gaps."""
    doy = F.dayofyear("date")
    return days.select(
        "date",
        F.when(doy % 150 != 0, F.lit(15) + (doy * 7) % 21).cast("double").alias("temp_max"),
        F.when(doy % 100 != 0, F.greatest(F.lit(0), (doy * 13) % 23 - 8)).cast("double").alias("precipitation"),
        (doy % 4).cast("int").alias("weathercode"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_weather_bins(weather_values(adapter.order_days(spark, sf_dir)))


def land_json(rows: DataFrame, path: str) -> str:
    """Write (date, temp_max, precipitation, weathercode) as JSON, one object of parallel arrays per
    month."""
    month = rows.groupBy(F.trunc("date", "month").alias("m")).agg(
        F.sort_array(F.collect_list(F.struct("date", "temp_max", "precipitation", "weathercode"))).alias("d")
    )
    daily = F.struct(
        F.transform("d", lambda x: x["date"].cast("string")).alias("time"),
        F.col("d.temp_max").alias("temperature_2m_max"),
        F.col("d.precipitation").alias("precipitation_sum"),
        F.col("d.weathercode").alias("weathercode"),
    )
    month.select(daily.alias("daily")).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table in the columns of a weather reading; a third of the values are left out."""
    e = adapter.table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").cast("date").alias("date"), F.col("value").alias("temp_max"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("precipitation"),
        (F.col("user_id") % 100).cast("int").alias("weathercode"),
    )
