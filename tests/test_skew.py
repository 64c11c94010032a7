"""A hot series holding most rows is split over many bounded window tasks."""

import datetime as dt

from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.series import SeriesSpec


def test_hot_series_chunked_plan(spark):
    # series "hot" has 3000 rows, the others 20 each
    rows = [("hot", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(i % 9)) for i in range(3000)]
    rows += [(f"s{k}", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(i % 4)) for k in range(5) for i in range(20)]
    df = spark.createDataFrame(rows, "series string, fecha date, precip double")
    spec = SeriesSpec(keys=("series",), time="fecha", chunk_rows=250)
    cfg = fe.FeatureConfig(rename={}, lag_vars=["precip"], rolling_vars=["precip"], windows=(7, 30),
                           streak_col="precip", streak_threshold=3.0, target_col="precip", wmo_col=None)
    out = fe.build_features(df, spec, cfg)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(series" in plan and "_pv_c" in plan   # windows keyed by (series, chunk)
    # same result as the per-series plan
    ref = fe.build_features(df, SeriesSpec(keys=("series",), time="fecha"), cfg)
    assert out.count() == 3100
    assert out.exceptAll(ref).count() == 0 and ref.exceptAll(out).count() == 0


def test_chunk_tasks_are_bounded(spark):
    from pluvio.series import SeriesWindow
    df = spark.range(5000).select(F.lit("hot").alias("series"),
                                  F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("id").cast("int")).alias("fecha"))
    sw = SeriesWindow(SeriesSpec(keys=("series",), time="fecha", chunk_rows=500), back=30, fwd=1)
    g = sw.prepare(df).groupBy("series", "_pv_c").agg(F.count(F.lit(1)).alias("n"),
                                                      F.count_if(~F.col("_pv_halo")).alias("live")).collect()
    live = [r for r in g if r["live"] > 0]
    # 10 chunks of real rows (+ one halo-only group after the last chunk, dropped later)
    assert len(live) == 10 and all(r["live"] == 500 for r in live)
    assert max(r["n"] for r in g) <= 500 + 30 + 1
