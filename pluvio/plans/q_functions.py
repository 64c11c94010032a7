"""Queries: scalar functions (FN7, FN9-15, FN19-20, FN23-24) and feature
alignment (PRJ7, PRJ8, SET2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio import functions as fn
from pluvio.operators.models import align_features, first_present, missing_features
from pluvio.plans import bindings as b
from pluvio.plans import q_features as qf
from pluvio.plans import sqlgen as sg
from pluvio.plans.registry import present, query, rnd


@query("numeric_functions", f"""
SELECT o_orderkey, {rnd('ABS(o_totalprice - 200000)')} AS abs_dev, {rnd('ROUND(SQRT(o_totalprice), 3)')} AS sqrt_price,
       {rnd('(o_totalprice / 1000) * (o_totalprice / 1000)')} AS sq,
       {rnd('GREATEST(o_totalprice - 250000, 0.0)')} AS clipped,
       CAST(o_totalprice > 250000 AS INTEGER) AS flag, CAST(trunc(o_totalprice / 1000) AS INTEGER) AS k_trunc,
       COALESCE(NULLIF(o_orderstatus, 'P'), 'pending') AS status
FROM orders""")
def q_numeric_functions(spark, sf_dir):
    """FN7/FN9/FN10/FN11/FN23 — abs, sqrt, square, rounding, clip at zero,
    bool→int, truncation, NULL-safe default."""
    o = b.table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    return present(o.select(
        "o_orderkey", F.abs(p - 200000).alias("abs_dev"), fn.round_to(F.sqrt(p), 3).alias("sqrt_price"),
        fn.square(p / 1000).alias("sq"), fn.clip_zero(p - 250000).alias("clipped"),
        fn.as_int_flag(p > 250000).alias("flag"), fn.truncate_int(p / 1000).alias("k_trunc"),
        fn.null_default(F.nullif(F.col("o_orderstatus"), F.lit("P")), "pending").alias("status")))


@query("date_functions", f"""
SELECT series, fecha, CAST(fecha + INTERVAL 1 DAY AS DATE) AS next_day, CAST(fecha - INTERVAL 30 DAY AS DATE) AS period_start,
       CAST(year(fecha) AS INTEGER) AS year, CAST(month(fecha) AS INTEGER) AS month,
       CAST(dayofyear(fecha) AS INTEGER) AS day_of_year,
       strftime(CAST(fecha AS TIMESTAMP) + INTERVAL 90 MINUTE, '%Y%m%d_%H%M') AS version,
       substring(CAST(fecha AS VARCHAR), 6, 5) AS month_day,
       TRY_CAST(CASE WHEN precip > 200 THEN CAST(fecha AS VARCHAR) ELSE 'not-a-date' END AS DATE) AS parsed
FROM ({sg.D_SQL}) d""")
def q_date_functions(spark, sf_dir):
    """FN12-15/FN20 — date arithmetic and parts, version stamp, guarded parse, MM-DD."""
    d = b.daily_lineitem(spark, sf_dir)
    t = F.col("fecha")
    parts = fn.date_parts(t)
    txt = F.when(F.col("precip") > 200, t.cast("string")).otherwise(F.lit("not-a-date"))
    return d.select(
        "series", "fecha", fn.days_after(t, 1).alias("next_day"), fn.days_before(t, 30).alias("period_start"),
        parts["year"].alias("year"), parts["month"].alias("month"), parts["day_of_year"].alias("day_of_year"),
        fn.version_stamp(t.cast("timestamp_ntz") + F.expr("INTERVAL 90 MINUTES")).alias("version"),
        fn.month_day(t).alias("month_day"), fn.safe_date(txt).alias("parsed"))


@query("text_json_functions", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       concat_ws(' | ', event_type, 'user ' || CAST(user_id AS VARCHAR)) AS label,
       format('{:,.2f}', value * 1000) AS value_text
FROM events""")
def q_text_json_functions(spark, sf_dir):
    """FN19/FN24 — JSON field access, label concatenation, formatted number."""
    e = b.table(spark, sf_dir, "events")
    return e.select(
        "event_id", fn.json_field(F.col("props"), "$.k").cast("long").alias("k"),
        fn.label(F.col("event_type"), F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("label"),
        F.format_number(F.col("value") * 1000, 2).alias("value_text"))


EXPECTED = ["precip_lag1", "n_lines_lag1", "precip_rmean_7", "temp_range_lag1", "racha_seca", "mes_sin",
            "pressure_trend_24h_lag1", "wmo_nieve"]


@query("align_features", f"""
SELECT series, fecha, precip AS target_source, {rnd('precip_lag1')} AS precip_lag1, n_lines_lag1,
       {rnd('precip_rmean_7')} AS precip_rmean_7, CAST(0.0 AS DOUBLE) AS temp_range_lag1, racha_seca, {rnd('mes_sin')} AS mes_sin,
       CAST(0.0 AS DOUBLE) AS pressure_trend_24h_lag1, wmo_nieve
FROM ({qf._feature_sql()}) t""")
def q_align_features(spark, sf_dir):
    """PRJ7/PRJ8/SET2 — the model's feature list in its order, features
    missing from the frame (plan-time set difference) filled with 0; the
    target source falls back from ``precipitation_sum`` to ``precip``."""
    f = qf._feature_table(spark, sf_dir)
    assert missing_features(f, EXPECTED) == ["temp_range_lag1", "pressure_trend_24h_lag1"]
    f = f.withColumn("target_source", first_present(f, "precipitation_sum", "precip"))
    return present(align_features(f, EXPECTED, keep=["series", "fecha", "target_source"]))
