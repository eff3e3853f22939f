"""The batch jobs, each from Parquet (or raw files) to Parquet.

    python -m stockweave.plans.jobs RAW_DIR WEATHER_JSON OUT_DIR

``RAW_DIR`` holds the five CSV files and users.csv, ``WEATHER_JSON`` the landed daily weather, ``OUT_DIR`` is a
folder all executors share. A job reads its inputs by name, so any of them can be run again alone.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.operators import (
    baskets,
    calendar,
    demand,
    demographics,
    features,
    forecast,
    fusion,
    master,
    rules,
    segments,
)
from stockweave.params import (
    CalendarParams,
    ForecastParams,
    FusionParams,
    MiningParams,
    RfmParams,
    SegmentParams,
    TimelineParams,
)
from stockweave.session import materialize, scratch_scope, tune
from stockweave.sources import raw, weather


@dataclass(frozen=True)
class Settings:
    calendar: CalendarParams = CalendarParams()
    timeline: TimelineParams = TimelineParams()
    rfm: RfmParams = RfmParams()
    mining: MiningParams = MiningParams()
    segments: SegmentParams = SegmentParams()
    forecast: ForecastParams = ForecastParams()
    fusion: FusionParams = FusionParams()
    clusters: int | None = None  # None: chosen by silhouette
    boosted: bool = True
    generated_at: datetime = field(default_factory=datetime.now)


@dataclass(frozen=True)
class Store:
    """Named Parquet tables below one folder."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}")

    def write(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        raw.write_parquet(df, f"{self.folder.rstrip('/')}/{name}", partition_by)


def ingest(store: Store, raw_dir: str, s: Settings = Settings()) -> None:
    store.write("master", master.build_master(**raw.load_raw(store.spark, raw_dir)))


def assign_users(store: Store, raw_dir: str, s: Settings = Settings()) -> None:
    path = f"{raw_dir.rstrip('/')}/{raw.RAW_FILES['orders']}"
    users = raw.read_csv(store.spark, path, "user_id long")
    store.write("user_demographics", demographics.assign_stores(users, raw.load_users(store.spark, raw_dir)))


def land_weather(store: Store, landed: str, s: Settings = Settings()) -> None:
    store.write("weather", weather.with_weather_bins(weather.read_weather_json(store.spark, landed)))


def build_calendar(store: Store, s: Settings = Settings()) -> None:
    """One row per day of the timeline."""
    ends = store.spark.range(1).select(
        F.explode(F.array(F.lit(s.timeline.anchor), F.lit(s.timeline.last_day))).alias("day")
    )
    store.write("events", calendar.event_calendar(calendar.day_spine(ends, F.col("day")), s.calendar))


def build_features(store: Store, raw_dir: str, s: Settings = Settings()) -> None:
    lines = store.read("master")
    store.write("feat_rfm", features.user_rfm(lines, s.rfm))
    dates = features.assign_order_dates(lines, raw.load_users(store.spark, raw_dir), s.timeline.last_day)
    store.write("order_context", features.order_context(dates, store.read("weather"), store.read("events")))
    store.write(
        "feature_store",
        features.feature_store(store.read("feat_rfm"), store.read("user_demographics"), store.read("order_context")),
    )


def segment_users(store: Store, s: Settings = Settings()) -> None:
    store.write("seg_labels", segments.segment_labels(store.read("feature_store"), s.clusters, s.segments))


def mine_rules(store: Store, s: Settings = Settings()) -> None:
    enriched = baskets.enrich_baskets(store.read("master"), store.read("order_context"), store.read("seg_labels"))
    store.write("assoc_rules", rules.context_rules(enriched, s.mining))


def forecast_demand(store: Store, s: Settings = Settings()) -> None:
    daily = materialize(
        demand.daily_demand(store.read("master"), store.read("order_context"), store.read("user_demographics")),
        "daily_demand",
    )
    series = demand.with_day_context(
        demand.demand_spine(daily, s.forecast.top_skus), store.read("weather"), store.read("events")
    )
    lagged = materialize(demand.lag_features(series, s.forecast.lags), "lagged_demand")
    if s.boosted:
        rows = materialize(demand.demand_features(lagged, s.forecast), "model_rows")
        out = forecast.boosted_forecast(rows, forecast.fit_boosted(rows, s.forecast), s.forecast)
    else:
        out = forecast.naive_forecast(lagged, s.forecast)
    store.write("forecasts", out, ("store_id",))


def fuse(store: Store, s: Settings = Settings()) -> None:
    forecasts = store.read("forecasts")
    actions = fusion.build_action_list(
        forecasts,
        fusion.current_stock(forecasts, s.fusion),
        fusion.dominant_segment(store.read("seg_labels"), store.read("user_demographics")),
        store.read("assoc_rules"),
        store.read("events"),
        s.generated_at,
        s.fusion,
    )
    store.write("action_list", actions, ("store_id",))


def run_all(spark: SparkSession, raw_dir: str, landed_weather: str, folder: str, s: Settings = Settings()) -> DataFrame:
    """All jobs in order; returns the ranked replenishment list."""
    store = Store(tune(spark), folder)
    with scratch_scope(spark):
        ingest(store, raw_dir, s)
        assign_users(store, raw_dir, s)
        land_weather(store, landed_weather, s)
        build_calendar(store, s)
        build_features(store, raw_dir, s)
        segment_users(store, s)
        mine_rules(store, s)
        forecast_demand(store, s)
        fuse(store, s)
    return fusion.ranked(store.read("action_list").select(*s.fusion.columns))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_dir")
    parser.add_argument("weather_json")
    parser.add_argument("out_dir")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("stockweave").getOrCreate()
    run_all(spark, args.raw_dir, args.weather_json, args.out_dir).show(20, truncate=False)


if __name__ == "__main__":
    main()
