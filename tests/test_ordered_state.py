"""The ordered streak equals the batch streak when rows arrive shuffled."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.series import SeriesSpec
from pluvio.session import checkpoint_dir, pin_utc, scratch_path
from pluvio.streaming import jobs as sj
from pluvio.streaming.ordered import ordered_streak, run_lengths, state_store

DAY0 = dt.date(2020, 1, 1)


def plain(values, threshold, before=None):
    out, last, streak = [], *(before or (None, None))
    for v in values:
        streak = 0 if streak is None or last is None or np.isnan(last) or last > threshold else streak + 1
        out.append(streak)
        last = v
    return out


def test_run_lengths():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 7, 60):
        for before in (None, (0.0, 4), (9.0, 4), (float("nan"), 2)):
            v = rnd.choice([0.0, 1.0, 5.0, np.nan], n)
            assert run_lengths(v, 1.0, before).tolist() == plain(v, 1.0, before)


@pytest.mark.parametrize("keys", [["series"], ["series", "site"]])
def test_shuffled_rows_give_the_batch_streak(spark, keys):
    """Rows of five series (a NULL key among them) in 6 micro-batches, moved
    by up to 20 days; a last row far ahead lets the watermark pass the rest."""
    checkpoint_dir(spark)
    pin_utc(spark)
    rnd, rows = random.Random(3), []
    for s, site in (("a", 1), ("a", 2), ("b", 1), (None, 1), ("b", None)):
        if keys == ["series"] and site != 1:
            continue
        for i in range(240):
            if rnd.random() < 0.9:
                rows.append((s, site, DAY0 + dt.timedelta(days=i), rnd.choice([0.0, 0.5, 3.0, None])))
    schema = "series string, site int, fecha date, precip double"
    batches = [[] for _ in range(6)]
    for r in rows:
        moved = (r[2] - DAY0).days + rnd.randrange(0, 20)
        batches[min(moved // 45, 5)].append(r)
    base = scratch_path(spark, "test-ordered")
    for b in [*batches, [("end", 0, DAY0 + dt.timedelta(days=400), 0.0)]]:
        rnd.shuffle(b)
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    with state_store(spark):
        s = ordered_streak(sj.file_stream(spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema, max_files=1), keys, 1.0, delay="60 days")
        sj._run(s.writeStream.outputMode("append").foreachBatch(sj.upsert_sink(f"{base}/out", [*keys, "fecha"], [])), f"{base}/ckpt")
    got = spark.read.parquet(f"{base}/out").drop("_batch")
    df = spark.createDataFrame(rows, schema)
    exp = fe.with_window_features(df, SeriesSpec(keys=tuple(keys), time="fecha"), {}, back=1, fwd=0,
                                  streaks=[("racha_seca", "precip", 1.0)]).select(*keys, "fecha", "racha_seca")
    assert got.count() == len(rows)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_late_rows_are_dropped(spark):
    checkpoint_dir(spark)
    pin_utc(spark)
    base, day = scratch_path(spark, "test-late"), lambda i: DAY0 + dt.timedelta(days=i)
    for b in ([("a", day(0), 0.0), ("a", day(2), 0.0)], [("a", day(50), 0.0)], [("a", day(51), 0.0)],
              [("a", day(1), 9.0), ("a", day(52), 0.0), ("a", day(52), 0.0)], [("x", day(200), 0.0)]):
        spark.createDataFrame(b, "series string, fecha date, precip double").coalesce(1).write.mode("append").parquet(f"{base}/src")
    with state_store(spark):
        s = ordered_streak(sj.file_stream(spark, f"{base}/src", spark.read.parquet(f"{base}/src").schema, max_files=1), ["series"], 1.0, delay="10 days")
        sj._run(s.writeStream.outputMode("append").foreachBatch(sj.upsert_sink(f"{base}/out", ["series", "fecha"], [])), f"{base}/ckpt")
    got = {(r.fecha - DAY0).days: r.racha_seca for r in spark.read.parquet(f"{base}/out").where(F.col("series") == "a").collect()}
    assert got == {0: 0, 2: 1, 50: 2, 51: 3, 52: 4}  # day 1 came after the watermark had passed it
