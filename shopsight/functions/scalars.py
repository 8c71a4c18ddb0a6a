"""Scalar column functions: calendar parts, rounding, formatting, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-6


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` with NULL instead of an error when ``b`` is zero."""
    return F.try_divide(a, b)


def whole_days(start: Column, end: Column) -> Column:
    """Whole days between two times (elapsed time, not calendar dates)."""
    return F.timestamp_diff("DAY", start, end)


def months_between_periods(start: Column, end: Column) -> Column:
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("int")


def calendar_parts(ts: str, prefix: str = "purchase_") -> dict[str, Column]:
    """Year, month, day, quarter, ISO week, Monday-based weekday, weekend flag, day name."""
    c = F.col(ts)
    return {
        f"{prefix}year": F.year(c),
        f"{prefix}month": F.month(c),
        f"{prefix}day": F.day(c),
        f"{prefix}quarter": F.quarter(c),
        f"{prefix}week": F.weekofyear(c),
        f"{prefix}weekday": F.weekday(c),
        f"{prefix}is_weekend": (F.weekday(c) >= 5).cast("int"),
        f"{prefix}day_name": F.date_format(c, "EEEE"),
    }


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a periodic value."""
    angle = 2 * F.pi() * value / period
    return F.sin(angle), F.cos(angle)


def period_start(ts: Column, period: str) -> Column:
    """Start of the day (D), month (M) or quarter (Q) as a date."""
    unit = {"D": "day", "M": "month", "Q": "quarter"}.get(period)
    if unit is None:
        raise ValueError(f"unknown period: {period}")
    return F.to_date(F.date_trunc(unit, ts))


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (``least``/``greatest`` alone would drop it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def join_text(*columns: str) -> Column:
    """Values joined by one space; NULL counts as empty text."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def bands(value: Column, steps: list[tuple[float, str]], otherwise: str, strict: bool = True) -> Column:
    """First label whose threshold is exceeded (``strict``) or reached; steps go downwards."""
    expr = None
    for threshold, label in steps:
        cond = value > threshold if strict else value >= threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(value.isNotNull(), expr.otherwise(otherwise))


def risk_band(probability: Column, high: float = 0.7, medium: float = 0.4) -> Column:
    return bands(probability, [(high, "High Risk"), (medium, "Medium Risk")], "Low Risk")


def lifespan_months(rating: Column) -> Column:
    return 12 + rating / 5 * 24


def format_currency(value: Column, currency: str = "USD") -> Column:
    text = F.format_number(value, 2)
    sign = {"USD": "$", "EUR": "\u20ac"}.get(currency.upper())
    return F.concat(F.lit(sign), text) if sign else F.concat(text, F.lit(f" {currency}"))


def format_percentage(value: Column, decimals: int = 1) -> Column:
    """Values up to 1 are shares, larger ones are already percentages."""
    return F.format_string(f"%.{decimals}f%%", F.when(value <= 1, value * 100).otherwise(value))


def format_thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def format_short(value: Column) -> Column:
    """1.2K / 3.4M / 5.6B notation."""
    size = F.abs(value)

    def scaled(div: float, suffix: str) -> Column:
        return F.concat(F.format_string("%.1f", value / div), F.lit(suffix))

    return (
        F.when(size >= 1e9, scaled(1e9, "B"))
        .when(size >= 1e6, scaled(1e6, "M"))
        .when(size >= 1e3, scaled(1e3, "K"))
        .otherwise(F.format_string("%.0f", value))
    )


def hash_uniform(seed: int, *keys: str) -> Column:
    """Deterministic uniform number in [0, 1) per key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003.0)
