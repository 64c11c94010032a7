"""Profiles, audits and simple filters over any frame (AGG2-3, AGG15-16,
FLT1, FLT3-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.operators.ranks import exact_quantiles
from pluvio.series import join_null_safe
from pluvio.session import materialize


def null_audit(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """FLT7 — NULL count per column in a single aggregation pass, unpivoted to
    (column_name, n_null) and restricted to columns that have NULLs."""
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "n_null")
    return long.filter(F.col("n_null") > 0)


def assert_no_nulls(df: DataFrame, cols: list[str] | None = None) -> None:
    bad = null_audit(df, cols).limit(1).collect()
    if bad:
        raise ValueError(f"column {bad[0]['column_name']} has {bad[0]['n_null']} NULLs")


def date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """FLT1 — inclusive on both ends (pushed into the Parquet scan)."""
    return df.filter(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def month_range(df: DataFrame, col: str, lo: int, hi: int) -> DataFrame:
    """FLT5 — keep months lo..hi (e.g. the rainy season 5..9)."""
    return df.filter(F.month(col).between(lo, hi))


def describe(df: DataFrame, col: str, keys: list[str] | tuple = (), approx: bool = False,
             accuracy: int = 10000) -> DataFrame:
    """AGG3 — count/mean/std/min/quartiles/max. Exact interpolated quartiles
    from the ranks of the counted values (``exact_quantiles``: no buffer holds
    a group); ``approx=True`` uses the mergeable sketch
    (``percentile_approx``) and needs one pass only."""
    x, keys = F.col(col), list(keys)
    if not keys:
        return describe(df.withColumn("_all", F.lit(1)), col, ["_all"], approx, accuracy).drop("_all")
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
    probs = [0.25, 0.5, 0.75]
    if approx:
        out = df.groupBy(*keys).agg(*aggs, F.percentile_approx(x, F.array(*[F.lit(p) for p in probs]), accuracy).alias("q"))
    else:
        df = materialize(df.select(*keys, col))  # two passes: moments and ranks
        out = join_null_safe(df.groupBy(*keys).agg(*aggs), exact_quantiles(df, col, probs, keys), keys, "left")
    return out.select(*keys, "n", "mean", "std", "min", *[F.col("q")[i].alias(f"q{int(100 * p)}") for i, p in enumerate(probs)], "max")


def class_balance(df: DataFrame, col: str, wet: float, peak: float,
                  keys: list[str] | tuple = ()) -> DataFrame:
    """AGG15 — wet/dry/peak counts, wet share and the class weight n_neg/n_pos."""
    is_wet = F.col(col) > wet
    n_wet = F.count_if(is_wet)
    n_dry = F.count_if(~is_wet)
    return df.groupBy(*keys).agg(
        n_wet.alias("n_wet"), n_dry.alias("n_dry"), F.count_if(F.col(col) > peak).alias("n_peak"),
        F.avg(is_wet.cast("int")).alias("wet_share"),
        F.try_divide(n_dry.cast("double"), F.nullif(n_wet, F.lit(0))).alias("class_weight"))


def extent(df: DataFrame, time: str, keys: list[str] | tuple = ()) -> DataFrame:
    """AGG16 — first/last time and row count per slice."""
    return df.groupBy(*keys).agg(F.min(time).alias("start"), F.max(time).alias("end"),
                                 F.count(F.lit(1)).alias("n"))
