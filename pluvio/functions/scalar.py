"""Scalar helpers used by the operators and available to users."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pluvio.operators.features import seasonal_columns, wmo_group, wmo_onehot_columns  # noqa: F401  FN2-5
from pluvio.operators.models import hurdle, magnitude  # noqa: F401  FN6-8
from pluvio.operators.monitor import degradation_limit, error_band, service_status  # noqa: F401  FN21-22
from pluvio.operators.runs import drop_keys, strip_prefix, typed_param  # noqa: F401  FN16-18

__all__ = [
    "clip_zero", "square", "round_to", "as_int_flag", "truncate_int",
    "days_after", "days_before", "date_parts", "version_stamp", "safe_date", "label", "month_day",
    "null_default", "json_field", "seasonal_columns", "wmo_group", "wmo_onehot_columns", "hurdle",
    "magnitude", "degradation_limit", "error_band", "service_status", "drop_keys", "strip_prefix",
    "typed_param",
]


def clip_zero(x: Column) -> Column:
    """FN7 — max(x, 0), NULL stays NULL."""
    return F.when(x.isNull(), None).otherwise(F.greatest(x, F.lit(0.0)))


def square(x: Column) -> Column:
    """FN9."""
    return x * x


def round_to(x: Column, places: int) -> Column:
    """FN10 — HALF_UP rounding to ``places`` decimals."""
    return F.round(x, places)


def as_int_flag(cond: Column) -> Column:
    """FN11 — boolean → 0/1."""
    return cond.cast("int")


def truncate_int(x: Column) -> Column:
    """FN11 — truncation toward zero, like Python ``int()``."""
    return x.cast("double").cast("int")


def days_after(d: Column, n: int) -> Column:
    """FN12."""
    return F.date_add(d, n)


def days_before(d: Column, n: int) -> Column:
    """FN12."""
    return F.date_sub(d, n)


def date_parts(d: Column) -> dict[str, Column]:
    """FN13 — year, month, day of year."""
    return {"year": F.year(d), "month": F.month(d), "day_of_year": F.dayofyear(d)}


def version_stamp(ts: Column) -> Column:
    """FN14 — model version label ``yyyyMMdd_HHmm``."""
    return F.date_format(ts, "yyyyMMdd_HHmm")


def safe_date(s: Column) -> Column:
    """FN15 — ISO date text → DATE, NULL when malformed (never raises)."""
    return F.try_to_date(s, "yyyy-MM-dd")


def label(*parts: Column, sep: str = " | ") -> Column:
    """FN19 — text label from parts (NULL parts skipped)."""
    return F.concat_ws(sep, *parts)


def month_day(d: Column) -> Column:
    """FN20 — ``MM-DD`` of a date."""
    return F.substring(d.cast("string"), 6, 5)


def null_default(x: Column, default) -> Column:
    """FN23 — NULL-safe default."""
    return F.coalesce(x, F.lit(default))


def json_field(js: Column, path: str) -> Column:
    """FN24 — field of a JSON text column."""
    return F.get_json_object(js, path)
