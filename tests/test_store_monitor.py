"""Upsert idempotence, append ids, monitoring guards, drift truth table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.operators import monitor as mo
from pluvio.operators import store as st
from pluvio.session import scratch_path


def test_upsert_latest_wins_and_replay(spark):
    d = dt.date(2024, 5, 1)
    w1 = spark.createDataFrame([(d, dt.datetime(2024, 5, 1, 1), 0.1), (d + dt.timedelta(1), dt.datetime(2024, 5, 1, 1), 0.2),
                                (d + dt.timedelta(2), dt.datetime(2024, 5, 1, 1), 0.3)],
                               "fecha date, written_at timestamp, prob double")
    w2 = spark.createDataFrame([(d, dt.datetime(2024, 5, 2, 1), 0.9), (d + dt.timedelta(3), dt.datetime(2024, 5, 2, 1), 0.4),
                                (d + dt.timedelta(1), dt.datetime(2024, 4, 30, 1), 0.0)],
                               "fecha date, written_at timestamp, prob double")
    path = scratch_path(spark, "test-upsert")
    st.upsert(spark, path, w1, ["fecha"], ["written_at"], partition_col="fecha")
    st.upsert(spark, path, w2, ["fecha"], ["written_at"], partition_col="fecha")
    got = {r["fecha"]: r["prob"] for r in spark.read.parquet(path).collect()}
    assert got == {d: 0.9, d + dt.timedelta(1): 0.2, d + dt.timedelta(2): 0.3, d + dt.timedelta(3): 0.4}
    st.upsert(spark, path, w2, ["fecha"], ["written_at"], partition_col="fecha")  # replay
    assert {r["fecha"]: r["prob"] for r in spark.read.parquet(path).collect()} == got


def test_append_log_ids_continue(spark):
    path = scratch_path(spark, "test-log")
    rows = spark.createDataFrame([(dt.datetime(2024, m, 1), m) for m in (1, 2, 3)], "evaluated_at timestamp, n_days int")
    st.append_log(spark, path, rows)
    more = spark.createDataFrame([(dt.datetime(2024, m, 1), m) for m in (4, 5)], "evaluated_at timestamp, n_days int")
    st.append_log(spark, path, more)
    got = sorted((r["id"], r["n_days"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]


def test_append_log_keeps_equal_stamps(spark):
    path = scratch_path(spark, "test-log")
    t = dt.datetime(2024, 1, 1)
    schema = "evaluated_at timestamp, run string, series string"
    st.append_log(spark, path, spark.createDataFrame([(t, "r1", "a"), (t, "r1", None)], schema))
    st.append_log(spark, path, spark.createDataFrame([(t, "r2", "a"), (t, "r2", None)], schema))
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    again = spark.createDataFrame([(t, "r2", "a"), (t, "r2", None), (t, "r2", "b")], schema)
    st.append_log(spark, path, again, replay_keys=["run", "series"])
    got = sorted((r["id"], r["run"], r["series"] or "") for r in spark.read.parquet(path).collect())
    assert len(got) == 5 and got[-1] == (5, "r2", "b")


def test_full_overwrite_leaves_nothing_behind(spark):
    path = scratch_path(spark, "test-full")
    st.save_table(spark.createDataFrame([(1, 1995), (2, 1996)], "v int, yr int"), path, ["yr"])
    st.save_table(spark.createDataFrame([(3, 1996)], "v int, yr int"), path, ["yr"])
    assert [(r.v, r.yr) for r in spark.read.parquet(path).collect()] == [(3, 1996)]
    st.save_table(spark.createDataFrame([(4, 1997)], "v int, yr int"), path, ["yr"], only_touched=True)
    assert sorted((r.v, r.yr) for r in spark.read.parquet(path).collect()) == [(3, 1996), (4, 1997)]


def test_monthly_periods_of_any_length(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "fecha date")
    for n in (1, 28, 45, 90, 365):
        counts = {r.ref_date: r["count"] for r in mo.monthly_periods(df, days=n).groupBy("ref_date").count().collect()}
        inner = [c for ref, c in counts.items() if days[0] <= ref - dt.timedelta(n) and ref - dt.timedelta(1) <= days[-1]]
        assert inner and set(inner) == {n}


def test_init_tables_idempotent(spark):
    root = scratch_path(spark, "test-init")
    p1 = st.init_tables(spark, root)
    p2 = st.init_tables(spark, root)
    assert p1 == p2 and spark.read.parquet(p1["actuals"]).count() == 0


def test_recent_performance_guards(spark):
    base = dt.date(2024, 1, 1)
    rows = [(base + dt.timedelta(i), 1.0 if i % 4 else 8.0, (2.0 if i < 14 else None)) for i in range(20)]
    pairs = spark.createDataFrame(rows, "fecha date, mm_actual double, mm_predicted double").withColumn("g", F.lit(1))
    r = mo.recent_performance(pairs, ["g"], threshold=0.5).first()
    assert r["n_days"] == 14 and r["rmse"] is None and r["recall"] is None
    r2 = mo.recent_performance(pairs, ["g"], threshold=0.5, min_days=10, min_wet=30).first()
    assert r2["rmse"] is not None and r2["recall"] is None


@pytest.mark.parametrize("rmse,recall,exp", [(None, 0.1, False), (10.0, None, False), (10.0, 0.1, True),
                                             (10.0, 0.9, False), (1.0, 0.1, False)])
def test_degradation_truth_table(spark, rmse, recall, exp):
    df = spark.createDataFrame([(rmse, recall)], "rmse double, recall double")
    assert df.select(mo.degradation(F.col("rmse"), F.col("recall"))).first()[0] is exp


def test_monthly_periods_each_row_in_its_runs(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 3, 15),)], "fecha date")
    got = sorted((r["fecha"], r["ref_date"]) for r in mo.monthly_periods(df).collect())
    assert got == [(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2024, 1, 31), dt.date(2024, 3, 1)),
                   (dt.date(2024, 3, 15), dt.date(2024, 4, 1))]
