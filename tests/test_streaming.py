"""Streaming availableNow runs equal their batch equivalents."""

import datetime as dt

from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.series import SeriesSpec
from pluvio.session import checkpoint_dir, scratch_path
from pluvio.streaming import jobs as sj


def test_stream_streak_equals_batch(spark):
    checkpoint_dir(spark)
    rows = []
    for s in ("a", "b"):
        for i in range(800):
            d = dt.date(2020, 1, 1) + dt.timedelta(days=i)
            rows.append((s, d, float((i * (3 if s == "a" else 5)) % 7), d.year))
    df = spark.createDataFrame(rows, "series string, fecha date, precip double, yr int")
    base = scratch_path(spark, "test-stream-streak")
    sj.ordered_file_drop(df, f"{base}/src", "yr", keys=["series"])
    schema = spark.read.parquet(f"{base}/src").schema
    s = sj.streak_stream(sj.file_stream(spark, f"{base}/src", schema, max_files=1), 2.0)
    sj._run(s.writeStream.outputMode("append").foreachBatch(sj.upsert_sink(f"{base}/out", ["series", "fecha"], [])),
            f"{base}/ckpt")
    got = spark.read.parquet(f"{base}/out").drop("_batch")
    exp = fe.with_window_features(df.drop("yr"), SeriesSpec(keys=("series",), time="fecha"), {}, back=1, fwd=0,
                                  streaks=[("racha_seca", "precip", 2.0)]).select("series", "fecha", "racha_seca")
    assert got.count() == 1600
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_stream_rollup_equals_batch(spark):
    checkpoint_dir(spark)
    base = scratch_path(spark, "test-stream-rollup")
    rows = [("x" if i % 3 else "y", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i % 11)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    # one file per day, in time order; one file per trigger → ~21 micro-batches
    sj.ordered_file_drop(df.withColumn("d", F.to_date("ts")), f"{base}/src", "d")
    out = sj.run_daily_rollup(spark, f"{base}/src", "*.parquet", df.schema, {"v": ["mean", "max", "count"]},
                              ["k"], f"{base}/out", f"{base}/ckpt", max_files=1)
    exp = df.groupBy("k", F.to_date("ts").alias("fecha")).agg(F.avg("v").alias("v_mean"), F.max("v").alias("v_max"),
                                                              F.count("v").alias("v_count"))
    a = {(r["k"], r["fecha"]): (round(r["v_mean"], 9), r["v_max"], r["v_count"]) for r in out.collect()}
    b = {(r["k"], r["fecha"]): (round(r["v_mean"], 9), r["v_max"], r["v_count"]) for r in exp.collect()}
    assert a == b


def test_upsert_newest_event_wins_over_later_arrival(spark):
    checkpoint_dir(spark)
    base = scratch_path(spark, "test-stream-upsert")
    schema = "fecha date, predicted_at timestamp, v int"
    d = dt.date(2024, 1, 1)
    for i, (day, v) in enumerate([(5, 50), (2, 20), (5, 55)]):  # one file and micro-batch each
        spark.createDataFrame([(d, dt.datetime(2024, 1, day), v)], schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    s = sj.file_stream(spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema, max_files=1)
    got = sj.run_upsert(spark, s, ["fecha"], ["predicted_at"], f"{base}/out", f"{base}/ckpt", partition_col="fecha").collect()
    assert len(got) == 1 and got[0].predicted_at.day == 5


def test_stream_reads_a_table_folder(spark):
    checkpoint_dir(spark)
    base = scratch_path(spark, "test-stream-folder")
    df = spark.range(100).selectExpr("id % 3 AS k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts", "CAST(id AS DOUBLE) AS v")
    df.repartition(4).write.parquet(f"{base}/events.parquet")
    out = sj.run_daily_rollup(spark, f"{base}/events.parque[t]", None, df.schema, {"v": ["count"]}, ["k"], f"{base}/out", f"{base}/ckpt")
    assert out.agg(F.sum("v_count")).first()[0] == 100
