"""All batch jobs, from raw CSV files to the replenishment list."""

from datetime import date, datetime

from registry import weather_input
from stockweave.operators import demographics
from stockweave.params import ForecastParams, MiningParams, SegmentParams, TimelineParams
from stockweave.plans import jobs
from stockweave.sources import adapter, raw

SF_DIR = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_path):
    tables = adapter.raw_tables(spark, SF_DIR)
    for name, file in raw.RAW_FILES.items():
        raw.write_csv(tables[name], str(tmp_path / "raw" / file))
    first = demographics.first_order_days(adapter.orders(spark, SF_DIR))
    users = adapter.demographics(spark, SF_DIR).join(first, "user_id")
    raw.write_csv(users.select("user_id", "pin_code", "city", "store_id", "first_order_date"), str(tmp_path / "raw" / "users.csv"))
    days = weather_input.weather_values(adapter.order_days(spark, SF_DIR))
    weather = weather_input.land_json(days, str(tmp_path / "weather"))
    s = jobs.Settings(
        timeline=TimelineParams(anchor=date(1995, 1, 1), last_day=date(2001, 8, 1)),
        mining=MiningParams(min_orders=10, min_support=0.1, max_len=2),
        segments=SegmentParams(k_values=(3,), restarts=1, sweep_restarts=1, max_iter=5, eps=2.5),
        forecast=ForecastParams(top_skus=6, rounds=2, leaves=8),
        clusters=3,
        generated_at=datetime(2024, 5, 1, 8, 20),
    )
    out = jobs.run_all(spark, str(tmp_path / "raw"), weather, str(tmp_path / "out"), s)
    store = jobs.Store(spark, str(tmp_path / "out"))
    master = store.read("master")
    users = master.select("user_id").distinct().count()
    assert store.read("feat_rfm").count() == users and len(store.read("feat_rfm").columns) == 11
    features = store.read("feature_store")
    assert features.count() == users and len(features.columns) == 19
    assert store.read("order_context").count() == master.select("order_id").distinct().count()
    assert store.read("seg_labels").count() == users
    assert store.read("events").count() == 2405
    forecasts = store.read("forecasts")
    assert set(forecasts.columns) == {
        "order_date", "store_id", "product_name", "units_sold", "forecast_units", "model_type", "mape",
    }
    rows = out.collect()
    assert rows and out.columns == list(s.fusion.columns)
    assert [r.store_id for r in rows] == sorted(r.store_id for r in rows)
    assert {r.generated_at for r in rows} == {datetime(2024, 5, 1, 8)}
    assert all(r.reorder_qty == max(r.forecast_units - r.current_stock, 0) for r in rows)


def test_a_scope_removes_what_was_written(spark):
    import os

    import pytest

    from stockweave.session import SCOPE_KEY, materialize, scratch_scope

    with scratch_scope(spark) as folder:
        assert materialize(spark.range(3), "three").count() == 3
        assert os.listdir(f"{folder}/stockweave")
    assert not os.path.exists(folder) and spark.conf.get(SCOPE_KEY, None) is None
    with pytest.raises(ZeroDivisionError), scratch_scope(spark) as folder:
        materialize(spark.range(1), "one")
        raise ZeroDivisionError
    assert not os.path.exists(folder)


def test_naive_forecast_job(spark):
    from stockweave.operators import demand, forecast

    lines = adapter.sales(spark, SF_DIR, ["order_id", "product_name"])
    dates = adapter.orders(spark, SF_DIR).select("order_id", "user_id", "order_date")
    daily = demand.daily_demand(lines, dates, adapter.demographics(spark, SF_DIR))
    out = forecast.naive_forecast(demand.demand_lags(demand.demand_spine(daily, 3)), ForecastParams(top_skus=3))
    row = out.first()
    assert row.model_type == "seasonal_naive" and row.mape > 0
