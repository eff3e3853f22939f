"""Column expressions: bins, slots, hashes, calendar parts, urgency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.params import URGENCY, CalendarParams, FusionParams

_PRIME = 2_147_483_647  # 2^31 - 1, so that products stay below 2^63


def mixed_hash(key: Column, salt: int = 0) -> Column:
    """Deterministic hash of an integer key into [0, 2^31 - 2].

    Three multiplicative rounds, plain integer arithmetic: the same in any SQL engine and
    independent of partitioning.
    """
    h = F.pmod(key.cast("long"), F.lit(_PRIME)) + F.lit(salt + 1)
    for factor in (48_271, 69_621, 16_807):
        h = (h * F.lit(factor) + F.lit(salt + 11)) % F.lit(_PRIME)
    return h


def pick_by_share(hashed: Column, shares: Sequence[tuple[str, int]]) -> Column:
    """Map a hash to labels by their percentage shares."""
    roll = hashed % F.lit(100)
    upper, out = 0, None
    for label, share in shares[:-1]:
        upper += share
        out = F.when(roll < upper, label) if out is None else out.when(roll < upper, label)
    last = shares[-1][0]
    return F.lit(last) if out is None else out.otherwise(last)


def right_closed_bin(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge, next edge] that holds ``x``; null outside and for null."""
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        hit = (x > F.lit(float(low))) & (x <= F.lit(float(high)))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def temp_bin(x: Column) -> Column:
    return right_closed_bin(x, (-999, 20, 30, 999), ("cold", "mild", "hot"))


def rain_bin(x: Column) -> Column:
    return right_closed_bin(x, (-1, 1, 10, 9999), ("dry", "drizzle", "heavy"))


def time_slot(hour: Column) -> Column:
    return (
        F.when(hour.between(6, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .when(hour.between(18, 21), "evening")
        .otherwise("night")
    )


def days_to_next(day: Column, dates: Sequence[str], cap: int) -> Column:
    """Days from ``day`` to the next of ``dates`` (today counts), at most ``cap``.

    The list is a parameter, so this is a projection and needs no join.
    """
    if not dates:
        return F.lit(cap)
    upcoming = F.filter(_date_array(dates), lambda d: d >= day)
    return F.least(F.coalesce(F.date_diff(F.array_min(upcoming), day), F.lit(cap)), F.lit(cap))


def in_any_window(day: Column, windows: Sequence[tuple[str, str]]) -> Column:
    hit = F.lit(False)
    for first, last in windows:
        hit = hit | day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return hit


def calendar_flags(day: Column, p: CalendarParams) -> dict[str, Column]:
    """The event columns of one day."""
    festival = day.isin([F.lit(d).cast("date") for d in p.festivals]) if p.festivals else F.lit(False)
    return {
        "is_festival": festival.cast("int"),
        "days_to_festival": days_to_next(day, p.festivals, p.max_days_ahead),
        "is_ipl_match_day": in_any_window(day, p.windows).cast("int"),
        "is_exam_season": F.month(day).isin(*p.exam_months).cast("int"),
        "is_monsoon": F.month(day).isin(*p.monsoon_months).cast("int"),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


def calendar_parts(day: Column) -> dict[str, Column]:
    """Weekday with Monday = 0, month, ISO week."""
    return {
        "day_of_week": F.weekday(day),
        "month": F.month(day),
        "week_of_year": F.weekofyear(day),
    }


def half_even_int(x: Column) -> Column:
    """Round half to even, then to int."""
    return F.bround(x, 0).cast("int")


def percentage_error(actual: Column, predicted: Column) -> Column:
    """|y - p| / (y + 1)."""
    return F.abs(actual - predicted) / (actual + F.lit(1.0))


def urgency_level(forecast: Column, stock: Column, days: Column, p: FusionParams) -> Column:
    return (
        F.when(forecast <= 0, 1)
        .when((forecast > stock) & (days <= p.critical_days), 5)
        .when(forecast > stock * F.lit(p.high_share), 4)
        .when(forecast > stock * F.lit(p.medium_share), 3)
        .otherwise(2)
    )


def urgency_label(level: Column) -> Column:
    return _lookup({k: v[0] for k, v in URGENCY.items()})[level]


def urgency_color(level: Column) -> Column:
    return _lookup({k: v[1] for k, v in URGENCY.items()})[level]


def event_context(festival: Column, league: Column, monsoon: Column) -> Column:
    return (
        F.when(festival == 1, "festival_soon")
        .when(league == 1, "ipl_season")
        .when(monsoon == 1, "monsoon")
        .otherwise("normal")
    )


def _lookup(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def _date_array(dates: Sequence[str]) -> Column:
    return F.array(*[F.lit(d).cast("date") for d in dates])
