"""Hourly → daily rollups (AGG1) and the daily ⟕ rollup join (JOIN1, SRC3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# name → aggregate builder. Any other name falls back to ``pyspark.sql.functions.<name>``.
AGGREGATES = {
    "mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum,
    "std": F.stddev_samp, "var": F.var_samp, "count": F.count, "first": F.first,
    "last": F.last, "median": F.median,
}


def _agg(fn_name: str):
    fn = AGGREGATES.get(fn_name) or getattr(F, fn_name, None)
    if fn is None:
        raise ValueError(f"unknown aggregate {fn_name!r}")
    return fn


def aggregate_to_daily(df: DataFrame, aggregations: dict[str, list[str]], time: str,
                       keys: list[str] | tuple = (), out_time: str = "fecha") -> DataFrame:
    """Group by (keys, calendar day) and apply ``{var: [fn, ...]}``.

    Output columns are named ``{var}_{fn}``; variables missing from ``df`` are
    skipped (decided at plan time). Spark plans this as a partial + final hash
    aggregate, so a hot key is pre-combined on the map side.
    """
    cols = set(df.columns)
    exprs: list[Column] = []
    for var, fns in aggregations.items():
        if var not in cols:
            continue
        for fn in fns:
            exprs.append(_agg(fn)(F.col(var)).alias(f"{var}_{fn}"))
    if not exprs:
        raise ValueError("none of the aggregated variables exist in the input")
    return df.groupBy(*keys, F.to_date(F.col(time)).alias(out_time)).agg(*exprs)


def join_daily(daily: DataFrame, rollup: DataFrame, keys: list[str] | tuple = (),
               time: str = "fecha") -> DataFrame:
    """JOIN1 — daily rows ⟕ their hourly rollup on (keys, day)."""
    return daily.join(rollup, list(keys) + [time], "left")


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: hourly variable → daily
# aggregates (output columns are named ``{variable}_{aggregate}``).
HOURLY_AGGREGATIONS = {
    "pressure_msl": ["mean", "min", "max"],
    "surface_pressure": ["mean"],
    "relative_humidity_2m": ["mean", "max"],
    "dew_point_2m": ["mean", "min"],
    "vapour_pressure_deficit": ["mean", "min"],
    "cloud_cover": ["mean", "max"],
    "cloud_cover_low": ["mean", "max"],
    "cloud_cover_mid": ["mean"],
    "cloud_cover_high": ["mean"],
    "wind_speed_10m": ["mean", "max"],
    "wind_direction_10m": ["mean"],
    "wind_gusts_10m": ["max"],
}
# ---------------------------------------------------------------------------
