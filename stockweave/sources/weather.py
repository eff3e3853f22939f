"""Daily weather from landed JSON: an object of parallel arrays becomes one row per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.scalars import rain_bin, temp_bin

WEATHER_SCHEMA = (
    "daily struct<time: array<string>, temperature_2m_max: array<double>, "
    "precipitation_sum: array<double>, weathercode: array<int>>"
)


def read_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """(date, temp_max, precipitation, weathercode) from one JSON object per line or file."""
    landed = spark.read.schema(WEATHER_SCHEMA).json(path)
    return explode_daily(landed)


def explode_daily(landed: DataFrame) -> DataFrame:
    days = F.arrays_zip(
        F.col("daily.time").alias("time"),
        F.col("daily.temperature_2m_max").alias("temp_max"),
        F.col("daily.precipitation_sum").alias("precipitation"),
        F.col("daily.weathercode").alias("weathercode"),
    )
    return landed.select(F.inline(days)).select(
        F.to_date("time").alias("date"),
        F.nanvl("temp_max", F.lit(None)).alias("temp_max"),
        F.nanvl("precipitation", F.lit(None)).alias("precipitation"),
        "weathercode",
    )


def with_weather_bins(weather: DataFrame) -> DataFrame:
    return weather.withColumn("temp_bin", temp_bin(F.col("temp_max"))).withColumn(
        "rain_bin", rain_bin(F.col("precipitation"))
    )
