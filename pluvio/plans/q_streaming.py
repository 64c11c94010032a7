"""Queries: Structured Streaming jobs run to completion with
``availableNow`` (STR1-STR4); each oracle is the SQL of the batch
equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.plans import bindings as b
from pluvio.plans import q_monitor as qm
from pluvio.plans import sqlgen as sg
from pluvio.plans.registry import present, query, rnd
from pluvio.session import checkpoint_dir, pin_utc, scratch_path
from pluvio.streaming import jobs as sj
from pluvio.streaming.ordered import ordered_streak, state_store


def _dirs(spark, name):
    checkpoint_dir(spark)
    base = scratch_path(spark, name)
    return f"{base}/table", f"{base}/_checkpoint", base


def _source(sf_dir, name):
    """(path, name filter) of a table for a file stream. A stream takes a
    glob of paths: it matches a table that is one file and finds the part
    files of a table that is a folder."""
    return f"{sf_dir.rstrip('/')}/{name}.parque[t]", None


@query("stream_daily_rollup", f"""
SELECT event_type, CAST(ts AS DATE) AS fecha, {rnd('AVG(value)')} AS value_mean, {rnd('MIN(value)')} AS value_min,
       {rnd('MAX(value)')} AS value_max, COUNT(value) AS value_count
FROM events GROUP BY 1, 2""")
def q_stream_daily_rollup(spark, sf_dir):
    """STR1 — events as a file stream → watermarked 1-day windows per event
    type, update mode, upserted per (type, day)."""
    pin_utc(spark)
    target, ckpt, _ = _dirs(spark, "stream-rollup")
    schema = b.table(spark, sf_dir, "events").schema
    out = sj.run_daily_rollup(spark, *_source(sf_dir, "events"), schema,
                              {"value": ["mean", "min", "max", "count"]}, ["event_type"], target, ckpt)
    return present(out)


@query("stream_upsert", f"""
WITH w2 AS (SELECT CAST(o_orderdate AS DATE) AS fecha, o_orderdate + INTERVAL 1 DAY AS predicted_at,
              ROUND(floor(o_totalprice / 60) / 10000.0, 4) AS prob_rain,
              ROUND(floor(o_totalprice / 10) / 1000.0, 3) AS mm_predicted,
              CAST(floor(o_totalprice / 60) / 10000.0 > 0.5 AS INTEGER) AS will_rain, 'v2' AS model_version,
              CAST(0.5 AS DOUBLE) AS threshold_used, o_orderkey AS seq FROM orders)
SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY fecha ORDER BY predicted_at DESC, seq DESC) AS r
                           FROM w2) x WHERE r = 1""")
def q_stream_upsert(spark, sf_dir):
    """STR2 — orders as a stream of prediction writes, upserted by date in
    ``foreachBatch`` (replay-safe: keyed, newest wins)."""
    pin_utc(spark)
    target, ckpt, _ = _dirs(spark, "stream-upsert")
    schema = b.table(spark, sf_dir, "orders").schema
    o = sj.file_stream(spark, _source(sf_dir, "orders")[0], schema)
    prob = F.floor(F.col("o_totalprice") / 60) / 10000.0
    writes = o.select(
        F.to_date("o_orderdate").alias("fecha"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAYS")).alias("predicted_at"),
        F.round(prob, 4).alias("prob_rain"), F.round(F.floor(F.col("o_totalprice") / 10) / 1000.0, 3).alias("mm_predicted"),
        (prob > 0.5).cast("int").alias("will_rain"), F.lit("v2").alias("model_version"),
        F.lit(0.5).alias("threshold_used"), F.col("o_orderkey").alias("seq"))
    return present(sj.run_upsert(spark, writes, ["fecha"], ["predicted_at", "seq"], target, ckpt,
                                 partition_col="fecha"))


@query("stream_error_window", f"""
WITH {qm.P_SQL},
x AS (SELECT CAST(fecha - INTERVAL (k) DAY AS DATE) AS window_start, * FROM fva, range(0, 30) t(k)),
g AS (SELECT window_start, CAST(window_start + INTERVAL 30 DAY AS DATE) AS window_end,
        COUNT(*) FILTER (WHERE mm_actual IS NOT NULL AND mm_predicted IS NOT NULL) AS n,
        SUM(CASE WHEN mm_actual IS NOT NULL AND mm_predicted IS NOT NULL THEN (mm_actual - mm_predicted) ** 2 END) AS sse,
        COUNT(*) FILTER (WHERE mm_actual IS NOT NULL AND mm_predicted IS NOT NULL AND mm_actual > {b.P_WET_THRESHOLD}) AS n_wet,
        COUNT(*) FILTER (WHERE mm_actual IS NOT NULL AND mm_predicted IS NOT NULL AND mm_actual > {b.P_WET_THRESHOLD}
                         AND mm_predicted > {b.P_WET_THRESHOLD}) AS hits
      FROM x GROUP BY 1, 2)
SELECT window_start, window_end, CAST(n AS INTEGER) AS n_days, {rnd('CASE WHEN n >= 15 THEN SQRT(sse / n) END')} AS rmse,
       {rnd('CASE WHEN n >= 15 AND n_wet >= 3 THEN CAST(hits AS DOUBLE) / n_wet END')} AS recall
FROM g""")
def q_stream_error_window(spark, sf_dir):
    """STR3 — forecast-vs-actual pairs (written by the batch join) replayed
    as a stream into daily panes; sliding 30-day windows every day are merged
    from them, with the AGG12 guards."""
    pin_utc(spark)
    target, ckpt, base = _dirs(spark, "stream-errors")
    pairs_dir = f"{base}/pairs"
    qm._fva(spark, sf_dir).write.mode("overwrite").parquet(pairs_dir)
    schema = spark.read.parquet(pairs_dir).schema
    s = sj.error_pane_stream(sj.file_stream(spark, pairs_dir, schema), b.P_WET_THRESHOLD)
    sj._run(s.writeStream.outputMode("update").foreachBatch(sj.upsert_sink(target, ["day"], [], partition_col="day")), ckpt)
    return present(sj.sliding_errors(sj.read_target(spark, target)))


@query("stream_streak", f"WITH d AS ({sg.D_SQL}) SELECT series, fecha, racha_seca FROM ("
       + sg.streak_sql("d", "precip", b.D_DRY_THRESHOLD, "series", "fecha") + ") s")
def q_stream_streak(spark, sf_dir):
    """STR4 — the daily series replayed as a stream in files that mix the days
    of a year; rows wait in ordered state until the watermark has passed
    them. A last row of another series, far ahead, lets it pass them all."""
    pin_utc(spark)
    target, ckpt, base = _dirs(spark, "stream-streak")
    src = f"{base}/daily"
    d = b.daily_lineitem(spark, sf_dir).select("series", "fecha", "precip", F.trunc("fecha", "year").alias("part"))
    end = d.agg(F.max("fecha").alias("m")).select(F.lit("end").alias("series"), F.date_add("m", 900).alias("fecha"), F.lit(0.0).alias("precip"),
                                                  F.date_add("m", 900).alias("part"))
    sj.ordered_file_drop(d.unionByName(end), src, "part", keys=["series"])
    schema = spark.read.parquet(src).schema
    with state_store(spark):
        s = ordered_streak(sj.file_stream(spark, src, schema, max_files=6), ["series"], b.D_DRY_THRESHOLD, delay="400 days")
        sj._run(s.writeStream.outputMode("append").foreachBatch(
            sj.upsert_sink(target, ["series", "fecha"], [], partition_col="fecha")), ckpt)
    return sj.read_target(spark, target)
