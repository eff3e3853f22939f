"""Parameters of the operators, as frozen dataclasses with the published defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# ---------------------------------------------------------------------------
# Results depend on them, so they are stated as they are.
# ---------------------------------------------------------------------------

# Festival dates (Diwali, Holi, Eid ul-Fitr, Navratri start, Dussehra), 2013-2015.
FESTIVALS_2013_2015 = (
    "2013-11-03", "2014-10-23", "2015-11-11",
    "2013-03-27", "2014-03-17", "2015-03-06",
    "2013-08-08", "2014-07-29", "2015-07-18",
    "2013-10-05", "2014-09-25", "2015-10-13",
    "2013-10-13", "2014-10-03", "2015-10-22",
)

# League season windows, first and last day, 2013-2015.
LEAGUE_WINDOWS_2013_2015 = (
    ("2013-04-03", "2013-05-26"),
    ("2014-04-16", "2014-06-01"),
    ("2015-04-08", "2015-05-24"),
)

# Urgency level -> label, colour.
URGENCY = {
    5: ("Critical", "#DC2626"),
    4: ("High", "#EA580C"),
    3: ("Medium", "#CA8A04"),
    2: ("Normal", "#16A34A"),
    1: ("Watch", "#6B7280"),
}

# Features the customer segmentation looks at.
CLUSTER_FEATURES = (
    "recency", "frequency", "monetary_proxy", "avg_basket_size", "reorder_ratio",
    "night_owl_score", "weekend_concentration", "avg_order_hour", "organic_affinity",
    "avg_days_between_orders", "pct_rainy_orders", "pct_festival_orders",
)

# Model input columns of the demand forecast.
DEMAND_FEATURES = (
    "lag_1d", "lag_7d", "lag_14d", "lag_30d",
    "rolling_7d_mean", "rolling_7d_std", "rolling_30d_mean",
    "day_of_week", "month", "week_of_year", "is_weekend",
    "is_festival", "days_to_festival", "is_ipl_match_day", "is_exam_season", "is_monsoon",
    "temp_max", "precipitation", "rain_enc", "store_enc", "sku_enc",
)

# Columns of the replenishment list.
ACTION_COLUMNS = (
    "store_id", "product_name", "forecast_units", "units_sold", "current_stock",
    "reorder_qty", "urgency", "urgency_label", "urgency_color", "dominant_segment",
    "bundle_with", "bundle_lift", "event_context", "days_to_festival", "generated_at",
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CalendarParams:
    """Special days. Dates are ISO strings; windows include both ends."""

    festivals: tuple[str, ...] = FESTIVALS_2013_2015
    windows: tuple[tuple[str, str], ...] = LEAGUE_WINDOWS_2013_2015
    exam_months: tuple[int, ...] = (3, 4, 10, 11)
    monsoon_months: tuple[int, ...] = (6, 7, 8, 9)
    max_days_ahead: int = 30


@dataclass(frozen=True)
class TimelineParams:
    """First and last day of the calendar."""

    anchor: date = date(2013, 1, 1)
    last_day: date = date(2015, 12, 31)


@dataclass(frozen=True)
class RfmParams:
    night_hours: tuple[int, ...] = (22, 23, 0, 1, 2, 3)
    weekend_days: tuple[int, ...] = (0, 6)
    affinity_pattern: str = "organic"


@dataclass(frozen=True)
class MiningParams:
    """Context rules over all orders, frequent items and itemset sizes of a slice.

    ``max_orders``, ``top_items`` and ``max_len`` cut them where a caller asks for that.
    """

    slice_cols: tuple[str, ...] = ("segment", "time_slot", "weather_bin")
    min_orders: int = 500
    max_orders: int | None = None
    top_items: int | None = None
    min_support: float = 0.02
    min_lift: float = 1.2
    min_confidence: float = 0.2
    max_len: int | None = None


@dataclass(frozen=True)
class SegmentParams:
    features: tuple[str, ...] = CLUSTER_FEATURES
    k_values: tuple[int, ...] = tuple(range(3, 11))
    restarts: int = 15
    sweep_restarts: int = 10
    seed: int = 42
    max_iter: int = 50
    eps: float = 1.2
    min_samples: int = 10


@dataclass(frozen=True)
class ForecastParams:
    top_skus: int | None = None
    lags: tuple[int, ...] = (1, 7, 14, 30)
    folds: int = 5
    rounds: int = 300
    step: float = 0.05
    leaves: int = 63
    bins: int = 64
    min_leaf_rows: int = 20
    seed: int = 42
    features: tuple[str, ...] = DEMAND_FEATURES
    nonzero_only: bool = True
    patience: int = 30


@dataclass(frozen=True)
class FusionParams:
    stock_factor: float = 0.8
    critical_days: int = 3
    high_share: float = 0.8
    medium_share: float = 0.6
    event_mode: str = "calendar_end"  # or "as_of": the event row of the forecast's own day
    columns: tuple[str, ...] = field(default=ACTION_COLUMNS)
