"""Queries: forecast-vs-actual monitoring and the operational store
(JOIN2, AGG12-14, AGG18, PRJ9-10, WIN9, FN21-22, SNK1-4, SRC5, ORD2-3, ORD6, FLT2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.operators import monitor as mo
from pluvio.operators import panes as pn
from pluvio.operators import store as st
from pluvio.plans import bindings as b
from pluvio.plans import sqlgen as sg
from pluvio.plans.registry import present, query, rnd
from pluvio.session import checkpoint_dir, materialize, scratch_path

BASE_RMSE = 2.0                           # stand-in baseline RMSE (units of P)
RECALL_MIN = 0.5

P_SQL = f"""
a AS (SELECT CAST(o_orderdate AS DATE) AS fecha, CAST(COUNT(*) AS DOUBLE) AS mm_actual,
             CAST(CAST(COUNT(*) AS DOUBLE) > {b.P_WET_THRESHOLD} AS INTEGER) AS did_rain FROM orders GROUP BY 1),
p AS (SELECT CAST(l_shipdate AS DATE) AS fecha, ROUND(LEAST(COUNT(*) / CAST(48 AS DOUBLE), 1.0), 4) AS prob_rain,
             ROUND(COUNT(*) / CAST(4 AS DOUBLE), 3) AS mm_predicted FROM lineitem GROUP BY 1),
pp AS (SELECT *, CAST(prob_rain > 0.5 AS INTEGER) AS will_rain, 'v1' AS model_version FROM p),
fva AS (SELECT a.fecha, a.mm_actual, a.did_rain, pp.prob_rain, pp.mm_predicted, pp.will_rain, pp.model_version
        FROM a LEFT JOIN pp ON a.fecha = pp.fecha)"""


def _fva(spark, sf_dir):
    """Every month there is: the monitoring queries run over whole tables."""
    return mo.forecast_vs_actual(b.actuals_by_day(spark, sf_dir), b.predictions_by_day(spark, sf_dir))


@query("forecast_vs_actual", f"WITH {P_SQL} SELECT * FROM fva WHERE fecha BETWEEN (SELECT MIN(fecha) FROM a) AND (SELECT MAX(fecha) FROM a)")
def q_forecast_vs_actual(spark, sf_dir):
    """JOIN2/FLT1 — actuals in a period ⟕ predictions by date; the period is
    the whole range of the actuals (one aggregate row)."""
    actuals = b.actuals_by_day(spark, sf_dir)
    period = actuals.agg(F.min("fecha"), F.max("fecha")).first()
    return present(mo.forecast_vs_actual(actuals, b.predictions_by_day(spark, sf_dir), *period))


_PERIODS_SQL = """
per AS (SELECT f.*, r AS ref_date, CAST(r - INTERVAL 30 DAY AS DATE) AS period_start,
               CAST(r - INTERVAL 1 DAY AS DATE) AS period_end
        FROM fva f, (SELECT DISTINCT CAST(date_trunc('month', fecha) + INTERVAL (k) MONTH AS DATE) AS r
                     FROM fva, range(1, 3) t(k)) m
        WHERE f.fecha BETWEEN CAST(r - INTERVAL 30 DAY AS DATE) AND CAST(r - INTERVAL 1 DAY AS DATE))"""


def _monitor_sql(thr=b.P_WET_THRESHOLD):
    both = "mm_actual IS NOT NULL AND mm_predicted IS NOT NULL"
    n = f"COUNT(*) FILTER (WHERE {both})"
    n_wet = f"COUNT(*) FILTER (WHERE {both} AND mm_actual > {thr})"
    hit = f"COUNT(*) FILTER (WHERE {both} AND mm_actual > {thr} AND mm_predicted > {thr})"
    return f"""
mon AS (SELECT ref_date, period_start, period_end, CAST({n} AS INTEGER) AS n_days,
          CASE WHEN {n} >= 15 THEN SQRT(AVG(CASE WHEN {both} THEN (mm_actual - mm_predicted) ** 2 END)) END AS rmse,
          CASE WHEN {n} >= 15 AND {n_wet} >= 3 THEN CAST({hit} AS DOUBLE) / {n_wet} END AS recall,
          {n_wet} AS n_wet
        FROM per GROUP BY 1, 2, 3)"""


def _monitor(spark, sf_dir, days=30):
    return pn.monthly_performance(_fva(spark, sf_dir), days, threshold=b.P_WET_THRESHOLD)


@query("monitor_metrics", f"WITH {P_SQL}, {_PERIODS_SQL}, {_monitor_sql()} "
       f"SELECT ref_date, period_start, period_end, n_days, {rnd('rmse')} AS rmse, {rnd('recall')} AS recall, n_wet FROM mon")
def q_monitor_metrics(spark, sf_dir):
    """AGG12/WIN9 — trailing-30-day RMSE and wet recall for every monthly run
    at once (RMSE NULL below 15 paired days, recall below 3 wet days)."""
    return present(_monitor(spark, sf_dir))


_PERIODS_90_SQL = _PERIODS_SQL.replace("INTERVAL 30 DAY", "INTERVAL 90 DAY").replace("range(1, 3)", "range(1, 5)")


@query("monitor_metrics_90_days", f"WITH {P_SQL}, {_PERIODS_90_SQL}, {_monitor_sql()} "
       f"SELECT ref_date, period_start, period_end, n_days, {rnd('rmse')} AS rmse, {rnd('recall')} AS recall, n_wet FROM mon")
def q_monitor_metrics_90_days(spark, sf_dir):
    """WIN9 — the same over 90 days, from the same daily panes."""
    return present(_monitor(spark, sf_dir, 90))


_DEGRADED_SQL = (f"COALESCE(rmse > {BASE_RMSE * 1.2} AND COALESCE(recall < {RECALL_MIN}, FALSE), FALSE)")


@query("drift_decision", f"WITH {P_SQL}, {_PERIODS_SQL}, {_monitor_sql()} "
       f"SELECT ref_date, {rnd('rmse')} AS rmse, {rnd('recall')} AS recall, {_DEGRADED_SQL} AS degraded, "
       f"ROUND(CAST({BASE_RMSE} AS DOUBLE) * (1 + CAST(0.2 AS DOUBLE)), 3) AS rmse_limit FROM mon")
def q_drift_decision(spark, sf_dir):
    """AGG18/FN22 — degraded iff RMSE over the limit AND recall under the
    minimum (missing RMSE → not degraded), per monthly run."""
    m = _monitor(spark, sf_dir)
    return present(m.select("ref_date", "rmse", "recall",
                            mo.degradation(F.col("rmse"), F.col("recall"), BASE_RMSE, 0.2, RECALL_MIN).alias("degraded"),
                            mo.degradation_limit(BASE_RMSE, 0.2).alias("rmse_limit")))


_DS_SQL = """
ds AS (SELECT fecha, ROUND(mm_predicted, 3) AS predicted, ROUND(mm_actual, 3) AS observed,
              ROUND(prob_rain, 4) AS prob_rain, CAST(will_rain AS BOOLEAN) AS will_rain,
              CAST(did_rain AS BOOLEAN) AS did_rain, ROUND(ABS(mm_predicted - mm_actual), 3) AS error,
              model_version FROM fva)"""


@query("dashboard_series", f"""WITH {P_SQL}, {_DS_SQL}
SELECT *, CASE WHEN error IS NULL THEN NULL WHEN error < 2.0 THEN 'good' WHEN error < 5.0 THEN 'warn' ELSE 'bad' END AS error_band
FROM ds""")
def q_dashboard_series(spark, sf_dir):
    """PRJ9/ORD1/FN21 — rounded dashboard rows, boolean flags, NULL-safe error and its band, by date."""
    s = mo.dashboard_series(_fva(spark, sf_dir))
    return present(s.withColumn("error_band", mo.error_band(F.col("error")))).orderBy("fecha")


def _dm_sql():
    both = "predicted IS NOT NULL AND observed IS NOT NULL"
    wet = f"{both} AND COALESCE(did_rain, FALSE)"
    n_wet = f"COUNT(*) FILTER (WHERE {wet})"
    return f"""
dm AS (SELECT CAST(date_trunc('month', fecha) AS DATE) AS month,
         ROUND(AVG(CASE WHEN {both} THEN ABS(predicted - observed) END), 3) AS mae,
         ROUND(SQRT(AVG(CASE WHEN {both} THEN ABS(predicted - observed) * ABS(predicted - observed) END)), 3) AS rmse,
         ROUND(CASE WHEN {n_wet} >= 3 THEN CAST(COUNT(*) FILTER (WHERE {wet} AND COALESCE(will_rain, FALSE)) AS DOUBLE) / {n_wet} END, 3) AS recall,
         COUNT(*) FILTER (WHERE {both}) AS n_days, {n_wet} AS n_rain_days_observed
       FROM ds GROUP BY 1)"""


@query("dashboard_metrics", f"WITH {P_SQL}, {_DS_SQL}, {_dm_sql()} SELECT * FROM dm")
def q_dashboard_metrics(spark, sf_dir):
    """AGG13 — dashboard MAE/RMSE (rounded pairs) and flag-based recall, per month."""
    s = mo.dashboard_series(_fva(spark, sf_dir)).withColumn("month", F.trunc("fecha", "month"))
    return present(mo.dashboard_metrics(s, ["month"]))


@query("status_bands", f"""WITH {P_SQL}, {_DS_SQL}, {_dm_sql()}
SELECT month, mae, rmse, recall,
  CASE WHEN rmse IS NULL THEN NULL WHEN (rmse - {BASE_RMSE}) / {BASE_RMSE} < 0.1 THEN 'good'
       WHEN (rmse - {BASE_RMSE}) / {BASE_RMSE} < 0.2 THEN 'warn' ELSE 'bad' END AS rmse_band,
  CASE WHEN recall IS NULL THEN NULL WHEN recall >= 0.6 THEN 'good' WHEN recall >= 0.5 THEN 'warn' ELSE 'bad' END AS recall_band
FROM dm""")
def q_status_bands(spark, sf_dir):
    """FN21 — RMSE-vs-baseline and recall bands of the monthly dashboard tiles."""
    s = mo.dashboard_series(_fva(spark, sf_dir)).withColumn("month", F.trunc("fecha", "month"))
    m = mo.dashboard_metrics(s, ["month"]).select("month", "mae", "rmse", "recall")
    return present(mo.status_bands(m, BASE_RMSE))


# ------------------------------- store ---------------------------------------

def _prediction_writes(spark, sf_dir):
    """First write: the lineitem-based forecasts; second write: one
    prediction per order for its date, written a day later (newest wins,
    order key breaks ties)."""
    first = b.predictions_by_day(spark, sf_dir).select(
        "fecha", (F.col("fecha").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("predicted_at"),
        "prob_rain", "mm_predicted", "will_rain", "model_version", "threshold_used",
        F.lit(0).cast("long").alias("seq"))
    o = b.table(spark, sf_dir, "orders")
    prob = F.floor(F.col("o_totalprice") / 60) / 10000.0
    second = o.select(
        F.to_date("o_orderdate").alias("fecha"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAYS")).alias("predicted_at"),
        F.round(prob, 4).alias("prob_rain"), F.round(F.floor(F.col("o_totalprice") / 10) / 1000.0, 3).alias("mm_predicted"),
        (prob > 0.5).cast("int").alias("will_rain"), F.lit("v2").alias("model_version"),
        F.lit(0.5).alias("threshold_used"), F.col("o_orderkey").alias("seq"))
    return first, second


_UPSERT_SQL = """
w1 AS (SELECT fecha, CAST(fecha AS TIMESTAMP) + INTERVAL 12 HOUR AS predicted_at, prob_rain, mm_predicted,
              CAST(prob_rain > 0.5 AS INTEGER) AS will_rain, 'v1' AS model_version, CAST(0.5 AS DOUBLE) AS threshold_used,
              CAST(0 AS BIGINT) AS seq FROM p),
w2 AS (SELECT CAST(o_orderdate AS DATE) AS fecha, o_orderdate + INTERVAL 1 DAY AS predicted_at,
              ROUND(floor(o_totalprice / 60) / 10000.0, 4) AS prob_rain,
              ROUND(floor(o_totalprice / 10) / 1000.0, 3) AS mm_predicted,
              CAST(floor(o_totalprice / 60) / 10000.0 > 0.5 AS INTEGER) AS will_rain, 'v2' AS model_version,
              CAST(0.5 AS DOUBLE) AS threshold_used, o_orderkey AS seq FROM orders),
merged AS (SELECT * EXCLUDE (r) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY fecha ORDER BY predicted_at DESC, seq DESC) AS r
  FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2) u) x WHERE r = 1)"""


def _merged(spark, sf_dir):
    """The predictions table after two upserts, read back from storage. It is
    partitioned by month, so the second write touches the months it has."""
    checkpoint_dir(spark)
    path, month = scratch_path(spark, "predictions"), F.date_format("fecha", "yyyy-MM")
    for rows in _prediction_writes(spark, sf_dir):
        st.upsert(spark, path, rows.withColumn("month", month), ["fecha"], ["predicted_at", "seq"], "month")
    return spark.read.parquet(path).drop("month")


@query("upsert_latest", f"WITH {P_SQL}, {_UPSERT_SQL} SELECT * FROM merged")
def q_upsert_latest(spark, sf_dir):
    """SNK3 — insert-or-replace by date: two writes into a stored table, each
    reduced with what is there to the newest row per key by a grouped
    ``max_by`` (no sort, hot keys pre-combined); the table read back."""
    return present(_merged(spark, sf_dir))


_LOG_SQL = f"""
logrows AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY ref_date) AS BIGINT) AS id,
              CAST(ref_date AS TIMESTAMP) AS evaluated_at, period_start, period_end, n_days,
              ROUND(rmse, 4) AS rmse_current, ROUND(recall, 4) AS recall_current,
              CAST({BASE_RMSE} AS DOUBLE) AS rmse_baseline, CAST({RECALL_MIN} AS DOUBLE) AS recall_baseline,
              CAST({_DEGRADED_SQL} AS INTEGER) AS degraded, 0 AS retrained,
              CAST(NULL AS VARCHAR) AS new_model_version,
              'rmse=' || COALESCE(CAST(ROUND(rmse, 3) AS VARCHAR), 'n/a') AS notes
            FROM mon)"""


def _log_rows(spark, sf_dir):
    m = _monitor(spark, sf_dir)
    rows = m.select(
        F.col("ref_date").cast("timestamp_ntz").alias("evaluated_at"), "period_start", "period_end", "n_days",
        F.col("rmse").alias("rmse_current"), F.col("recall").alias("recall_current"),
        F.lit(BASE_RMSE).alias("rmse_baseline"), F.lit(RECALL_MIN).alias("recall_baseline"),
        mo.degradation(F.col("rmse"), F.col("recall"), BASE_RMSE, 0.2, RECALL_MIN).cast("int").alias("degraded"),
        F.lit(0).alias("retrained"), F.lit(None).cast("string").alias("new_model_version"),
        F.concat(F.lit("rmse="), F.coalesce(F.round("rmse", 3).cast("string"), F.lit("n/a"))).alias("notes"))
    return rows


def _log(spark, sf_dir):
    """The evaluation log after two appends, read back from storage: the runs
    up to a date, then the later ones, whose ids go on from the first."""
    checkpoint_dir(spark)
    path, rows = scratch_path(spark, "retraining-log"), materialize(_log_rows(spark, sf_dir))
    early = F.col("evaluated_at") < F.lit("1995-06-15").cast("timestamp_ntz")
    for part in (rows.where(early), rows.where(~early)):
        st.append_log(spark, path, part)
    return spark.read.parquet(path)


@query("append_log", f"WITH {P_SQL}, {_PERIODS_SQL}, {_monitor_sql()}, {_LOG_SQL} SELECT * FROM logrows")
def q_append_log(spark, sf_dir):
    """SNK4 — evaluation log appended in two writes: ids continue from the
    stored ones (dense index, no global sort), metrics rounded to 4 dp."""
    return present(_log(spark, sf_dir))


@query("retrain_history", f"""WITH {P_SQL}, {_PERIODS_SQL}, {_monitor_sql()}, {_LOG_SQL}
SELECT id, evaluated_at, period_start, period_end, n_days, rmse_current, recall_current,
       CAST(degraded AS BOOLEAN) AS degraded, CAST(retrained AS BOOLEAN) AS retrained, notes
FROM logrows ORDER BY evaluated_at DESC""")
def q_retrain_history(spark, sf_dir):
    """PRJ10/ORD6 — typed evaluation history, newest first."""
    lg = _log(spark, sf_dir)
    return present(lg.select("id", "evaluated_at", "period_start", "period_end", "n_days", "rmse_current",
                             "recall_current", F.col("degraded").cast("boolean").alias("degraded"),
                             F.col("retrained").cast("boolean").alias("retrained"), "notes")
                   .orderBy(F.col("evaluated_at").desc()))


@query("store_stats", f"""WITH {P_SQL}, {_UPSERT_SQL}, {_PERIODS_SQL}, {_monitor_sql()}, {_LOG_SQL}
SELECT 'predictions' AS table_name, COUNT(*) AS n_rows, CAST(MAX(fecha) AS VARCHAR) AS latest FROM merged
UNION ALL SELECT 'actuals', COUNT(*), CAST(MAX(fecha) AS VARCHAR) FROM a
UNION ALL SELECT 'retraining_log', COUNT(*), CAST(MAX(CAST(evaluated_at AS DATE)) AS VARCHAR) FROM logrows""")
def q_store_stats(spark, sf_dir):
    """AGG14/ORD3 — row counts and latest dates of the three tables."""
    lg = _log(spark, sf_dir).withColumn("d", F.to_date("evaluated_at"))
    return st.table_stats({"predictions": _merged(spark, sf_dir), "actuals": b.actuals_by_day(spark, sf_dir),
                           "retraining_log": lg}, {"predictions": "fecha", "actuals": "fecha", "retraining_log": "d"})


@query("recent_n", f"WITH {P_SQL}, {_UPSERT_SQL} SELECT * FROM merged ORDER BY fecha DESC LIMIT 30")
def q_recent_n(spark, sf_dir):
    """ORD2 — the 30 newest stored predictions (top-k, the feature itself)."""
    return present(st.recent(_merged(spark, sf_dir), "fecha", 30))


@query("prediction_lookup", f"WITH {P_SQL}, {_UPSERT_SQL} SELECT * FROM merged WHERE fecha = DATE '1998-06-15'")
def q_prediction_lookup(spark, sf_dir):
    """FLT2 — key lookup of one stored prediction by date."""
    return present(_merged(spark, sf_dir).filter(F.col("fecha") == F.lit("1998-06-15").cast("date")))


@query("saved_table_roundtrip", f"""
SELECT series, fecha, {rnd('precip')} AS precip FROM ({sg.D_SQL}) d WHERE year(fecha) BETWEEN 1996 AND 1997""")
def q_saved_table_roundtrip(spark, sf_dir):
    """SNK1/SRC4/FLT1 — the daily table saved partitioned by year (full
    overwrite) and read back with a year filter that prunes partitions."""
    checkpoint_dir(spark)
    path = scratch_path(spark, "daily-table")
    d = b.daily_lineitem(spark, sf_dir).withColumn("yr", F.year("fecha"))
    st.save_table(d, path, ["yr"])
    back = spark.read.parquet(path).filter(F.col("yr").between(1996, 1997))
    return present(back.select("series", "fecha", "precip"))
