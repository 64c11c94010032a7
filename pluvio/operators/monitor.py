"""Forecast-vs-actual monitoring (JOIN2, AGG12-13, AGG18, PRJ9, WIN9, FN21-22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference: minimum paired days for an evaluation,
# minimum wet days for a recall, baseline RMSE and degradation limits,
# and the dashboard status bands.
MIN_DAYS_FOR_EVALUATION = 15
MIN_WET_DAYS = 3
BASELINE_RMSE = 4.676
RMSE_MAX_PCT_INCREASE = 0.20
RECALL_MIN = 0.50
WET_THRESHOLD = 0.5
ERROR_BANDS = (2.0, 5.0)          # abs error < 2 good, < 5 warn, else bad
RMSE_VS_BASE_BANDS = (0.10, 0.20)  # relative RMSE increase < 10% good, < 20% warn
RECALL_BANDS = (0.6, 0.5)          # recall >= .6 good, >= .5 warn


def forecast_vs_actual(actuals: DataFrame, predictions: DataFrame, start=None, end=None,
                       keys: list[str] | tuple = ()) -> DataFrame:
    """JOIN2 — actuals in [start, end] ⟕ predictions on (keys, fecha).

    The period filter is applied to both sides so it reaches both scans
    (predictions outside the period can never match)."""
    a, p = actuals, predictions
    if start is not None:
        a = a.filter(F.col("fecha") >= F.lit(start).cast("date"))
        p = p.filter(F.col("fecha") >= F.lit(start).cast("date"))
    if end is not None:
        a = a.filter(F.col("fecha") <= F.lit(end).cast("date"))
        p = p.filter(F.col("fecha") <= F.lit(end).cast("date"))
    p = p.select(*keys, "fecha", "prob_rain", "mm_predicted", "will_rain", "model_version")
    return a.select(*keys, "fecha", "mm_actual", "did_rain").join(p, list(keys) + ["fecha"], "left")


def monthly_periods(df: DataFrame, time: str = "fecha", days: int = 30) -> DataFrame:
    """WIN9 for every monthly run at once: each row goes to the runs whose
    trailing period ``[ref - days, ref - 1]`` contains it, with ``ref`` the
    first day of a month. A row belongs to about ``days / 30`` such periods,
    so the expansion is a bounded ``explode`` — no join, no cross product."""
    t = F.col(time)
    m0 = F.trunc(t, "month")
    # a period of `days` days reaches back over at most days // 28 + 1 month starts
    cands = F.array(*[F.add_months(m0, k) for k in range(1, days // 28 + 2)])
    ok = F.filter(cands, lambda r: (F.date_sub(r, days) <= t) & (t <= F.date_sub(r, 1)))
    return df.withColumn("ref_date", F.explode(ok)).withColumns({
        "period_start": F.date_sub("ref_date", days), "period_end": F.date_sub("ref_date", 1)})


def recent_performance(pairs: DataFrame, keys: list[str] | tuple,
                       threshold: float = WET_THRESHOLD, min_days: int = MIN_DAYS_FOR_EVALUATION,
                       min_wet: int = MIN_WET_DAYS) -> DataFrame:
    """AGG12 — RMSE and wet-day recall over complete pairs of each group;
    RMSE NULL below ``min_days`` pairs, recall NULL below ``min_wet`` wet days.
    Recall here uses the predicted amount (``mm_predicted > threshold``)."""
    both = F.col("mm_actual").isNotNull() & F.col("mm_predicted").isNotNull()
    err2 = F.when(both, F.pow(F.col("mm_actual") - F.col("mm_predicted"), 2))
    wet = both & (F.col("mm_actual") > threshold)
    n = F.count_if(both)
    n_wet = F.count_if(wet)
    hit = F.count_if(wet & (F.col("mm_predicted") > threshold))
    return pairs.groupBy(*keys).agg(
        n.cast("int").alias("n_days"),
        F.when(n >= min_days, F.sqrt(F.avg(err2))).alias("rmse"),
        F.when((n >= min_days) & (n_wet >= min_wet), hit / n_wet).alias("recall"),
        n_wet.alias("n_wet"))


def degradation(rmse: Column, recall: Column, baseline_rmse: float = BASELINE_RMSE,
                pct: float = RMSE_MAX_PCT_INCREASE, recall_min: float = RECALL_MIN) -> Column:
    """AGG18 — degraded iff RMSE above ``base·(1+pct)`` AND recall below the
    minimum; NULL RMSE → not degraded, NULL recall → recall not degraded."""
    rmse_bad = rmse > F.lit(baseline_rmse * (1 + pct))
    recall_bad = F.coalesce(recall < F.lit(recall_min), F.lit(False))
    return F.coalesce(rmse_bad & recall_bad, F.lit(False))


def degradation_limit(baseline_rmse: float = BASELINE_RMSE, pct: float = RMSE_MAX_PCT_INCREASE) -> Column:
    """FN22 — the RMSE limit shown to users, rounded to 3 dp."""
    return F.round(F.lit(baseline_rmse) * (1 + F.lit(pct)), 3)


def dashboard_series(pairs: DataFrame) -> DataFrame:
    """PRJ9 — rounded predicted/observed/probability, flags as booleans
    and a NULL-safe absolute error (NULL unless both values exist). Charts
    order the rows by date where they present them."""
    return pairs.select(
        "fecha", F.round("mm_predicted", 3).alias("predicted"), F.round("mm_actual", 3).alias("observed"),
        F.round("prob_rain", 4).alias("prob_rain"), F.col("will_rain").cast("boolean").alias("will_rain"),
        F.col("did_rain").cast("boolean").alias("did_rain"),
        F.round(F.abs(F.col("mm_predicted") - F.col("mm_actual")), 3).alias("error"), "model_version")


def dashboard_metrics(series: DataFrame, keys: list[str] | tuple = (), min_wet: int = MIN_WET_DAYS) -> DataFrame:
    """AGG13 — MAE/RMSE of the rounded pairs, recall of the stored flag
    (``will_rain``) over observed wet days (NULL below ``min_wet``)."""
    both = F.col("predicted").isNotNull() & F.col("observed").isNotNull()
    err = F.when(both, F.abs(F.col("predicted") - F.col("observed")))
    wet = both & F.coalesce(F.col("did_rain"), F.lit(False))
    n_wet = F.count_if(wet)
    hit = F.count_if(wet & F.coalesce(F.col("will_rain"), F.lit(False)))
    return series.groupBy(*keys).agg(
        F.round(F.avg(err), 3).alias("mae"), F.round(F.sqrt(F.avg(err * err)), 3).alias("rmse"),
        F.round(F.when(n_wet >= min_wet, hit / n_wet), 3).alias("recall"),
        F.count_if(both).alias("n_days"), n_wet.alias("n_rain_days_observed"))


def error_band(err: Column) -> Column:
    """FN21 — per-day absolute error band: < 2 good, < 5 warn, else bad."""
    g, f = ERROR_BANDS
    return F.when(err.isNull(), None).when(err < g, "good").when(err < f, "warn").otherwise("bad")


def status_bands(df: DataFrame, baseline_rmse: float = BASELINE_RMSE) -> DataFrame:
    """FN21 — bands of the metric tiles: RMSE relative to the baseline
    (< 10% good, < 20% warn) and recall (>= .6 good, >= .5 warn)."""
    rel = (F.col("rmse") - F.lit(baseline_rmse)) / F.lit(baseline_rmse)
    r_good, r_fair = RECALL_BANDS
    v_good, v_fair = RMSE_VS_BASE_BANDS
    return df.withColumns({
        "rmse_band": F.when(F.col("rmse").isNull(), None).when(rel < v_good, "good")
                      .when(rel < v_fair, "warn").otherwise("bad"),
        "recall_band": F.when(F.col("recall").isNull(), None).when(F.col("recall") >= r_good, "good")
                        .when(F.col("recall") >= r_fair, "warn").otherwise("bad"),
    })


def service_status(model_loaded: Column) -> Column:
    """FN21 — service health label."""
    return F.when(model_loaded, F.lit("ok")).otherwise(F.lit("degradado"))
