"""Sliding periods from daily panes (WIN9, STR3, AGG12).

Rows are summed up once by series and day. A period of any length is then a
range of days over those sums, so no row is copied into the periods that it
belongs to, and a period costs the days of its series, not their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.monitor import MIN_DAYS_FOR_EVALUATION, MIN_WET_DAYS, WET_THRESHOLD

SUMS = ("n_rows", "n_pairs", "sse", "n_wet", "hits")


def error_sums(threshold: float = WET_THRESHOLD) -> list[Column]:
    """What AGG12 needs of a pane, as sums that can be merged."""
    both = F.col("mm_actual").isNotNull() & F.col("mm_predicted").isNotNull()
    wet = both & (F.col("mm_actual") > threshold)
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(both).alias("n_pairs"),
            F.sum(F.when(both, F.pow(F.col("mm_actual") - F.col("mm_predicted"), 2)).otherwise(0.0)).alias("sse"),
            F.count_if(wet).alias("n_wet"), F.count_if(wet & (F.col("mm_predicted") > threshold)).alias("hits")]


def daily_panes(pairs: DataFrame, keys: list[str] | tuple = (), time: str = "fecha", threshold: float = WET_THRESHOLD) -> DataFrame:
    """(keys, day, sums): partial and final hash aggregate."""
    return pairs.groupBy(*keys, F.to_date(time).alias("day")).agg(*error_sums(threshold))


def _day(col) -> Column:
    return F.date_diff(col, F.lit("1970-01-01").cast("date"))


def sliding(panes: DataFrame, ends: DataFrame, days: int, keys: list[str] | tuple = ()) -> DataFrame:
    """(keys, end, sums): for each end the panes of ``[end - days, end - 1]``;
    an end without any row in its period is left out. Ends join the panes of
    their series as rows without weight, and a range frame adds up."""
    keys, zero = list(keys), [F.lit(0).cast("double" if s == "sse" else "long").alias(s) for s in SUMS]
    own = panes.select(*keys, F.col("day").alias("end"), *SUMS, F.lit(False).alias("_end"))
    both = own.unionByName(ends.select(*keys, "end", *zero, F.lit(True).alias("_end")))
    w = Window.partitionBy(*keys).orderBy(_day("end")).rangeBetween(-days, -1)
    summed = both.select(*keys, "end", "_end", *[F.sum(s).over(w).alias(s) for s in SUMS])
    return summed.where(F.col("_end") & (F.col("n_rows") > 0)).drop("_end")


def every_day(panes: DataFrame, days: int, keys: list[str] | tuple = ()) -> DataFrame:
    """(keys, end): each day whose period reaches a pane of its series."""
    lo, hi = F.date_add(F.min("day"), 1), F.date_add(F.max("day"), days)
    return panes.groupBy(*keys).agg(F.sequence(lo, hi).alias("e")).select(*keys, F.explode("e").alias("end"))


def month_starts(panes: DataFrame, days: int, keys: list[str] | tuple = ()) -> DataFrame:
    """(keys, end): each first of a month whose period reaches a pane."""
    lo, hi = F.trunc(F.add_months(F.min("day"), 1), "month"), F.trunc(F.date_add(F.max("day"), days), "month")
    both = panes.groupBy(*keys).agg(lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    return both.select(*keys, F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("end"))


def guarded(sums: DataFrame, *columns: str, min_days: int = MIN_DAYS_FOR_EVALUATION, min_wet: int = MIN_WET_DAYS) -> DataFrame:
    """AGG12 of merged sums: RMSE NULL below ``min_days`` pairs, recall also
    NULL below ``min_wet`` wet days."""
    n = F.col("n_pairs")
    return sums.select(*columns, n.cast("int").alias("n_days"), F.when(n >= min_days, F.sqrt(F.col("sse") / n)).alias("rmse"),
                       F.when((n >= min_days) & (F.col("n_wet") >= min_wet), F.col("hits") / F.col("n_wet")).alias("recall"), "n_wet")


def monthly_performance(pairs: DataFrame, days: int = 30, keys: list[str] | tuple = (), threshold: float = WET_THRESHOLD) -> DataFrame:
    """WIN9/AGG12 — the evaluation of every monthly run: periods of ``days``
    days that end before the first of a month."""
    panes = daily_panes(pairs, keys, threshold=threshold)
    s = sliding(panes, month_starts(panes, days, keys), days, keys)
    s = s.withColumns({"period_start": F.date_sub("end", days), "period_end": F.date_sub("end", 1)}).withColumnRenamed("end", "ref_date")
    return guarded(s, *keys, "ref_date", "period_start", "period_end")
