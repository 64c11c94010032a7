"""NULL keys and NULL times are kept by every plan; big numbers stay whole."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.operators import metrics as mt
from pluvio.operators import runs as rn
from pluvio.operators import splits as sp
from pluvio.series import SeriesSpec, dense_index


@pytest.fixture(scope="module")
def series(spark):
    d0 = dt.date(2024, 1, 1)
    rows = [(s, d0 + dt.timedelta(i), float(i * 7 % 5)) for s in ("a", None) for i in range(100)]
    return spark.createDataFrame(rows, "series string, fecha date, precip double")


@pytest.mark.parametrize("chunk", [None, 7])
def test_dense_index_keeps_null_series(series, chunk):
    got = dense_index(series, SeriesSpec(keys=("series",), time="fecha", chunk_rows=chunk), "i").collect()
    for s in ("a", None):
        assert sorted(r.i for r in got if r.series == s) == list(range(100))


def test_dense_index_keeps_null_times(spark):
    df = spark.createDataFrame([("a", None), ("a", dt.date(2024, 1, 1)), (None, None)], "series string, fecha date")
    assert dense_index(df, SeriesSpec(keys=("series",), time="fecha"), "i").count() == 3


def test_window_plans_agree_on_null_keys(series):
    stage = {"roll": lambda sw: fe.rolling_columns(sw, ["precip"], (3, 7))}
    out = [fe.with_window_features(series, SeriesSpec(keys=("series",), time="fecha", chunk_rows=c), stage, back=7, fwd=0,
                                   streaks=[("s", "precip", 1.0)]).select("series", "fecha", "s", "precip_rmean_3", "precip_rmax_7")
           for c in (None, 7)]
    assert out[0].count() == out[1].count() == 200
    assert out[0].exceptAll(out[1]).count() == 0


def test_streak_carry_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(fe, "CARRY_CHUNKS", 2)
    d0 = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("a", d0 + dt.timedelta(i), 5.0 if i in (3, 90) else 0.0) for i in range(150)], "series string, fecha date, precip double")
    run = lambda c: fe.with_window_features(df, SeriesSpec(keys=("series",), time="fecha", chunk_rows=c), {}, back=1, fwd=0,
                                            streaks=[("s", "precip", 1.0)]).orderBy("fecha").select("s").collect()
    assert run(None) == run(4)


def test_splits_keep_null_series_and_refuse_short_ones(spark, series):
    spec = SeriesSpec(keys=("series",), time="fecha")
    assert sp.train_test_split(series, spec).groupBy("series", "role").count().count() == 4
    folded = sp.assign_folds(series, spec, n_splits=2, test_size=10, min_train_size=30)
    assert folded.where("series IS NULL AND role = 'test'").count() == 20
    mixed = series.unionByName(spark.createDataFrame([("short", dt.date(2024, 1, 1), 1.0)], series.schema))
    with pytest.raises(ValueError, match="short"):
        sp.assign_folds(mixed, spec, n_splits=2, test_size=10, min_train_size=30)
    left = sp.short_series(sp.series_lengths(mixed, spec), ["series"], 10, 30).collect()
    assert [(r.series, r.n, r.needed) for r in left] == [("short", 1, 40)]
    assert sp.assign_folds(mixed, spec, n_splits=2, test_size=10, min_train_size=30, short="drop").count() == folded.count()
    for tail, n in ((True, 5), (False, 95)):
        got = {r.series: r["count"] for r in sp.last_rows(series, spec, 5, tail).groupBy("series").count().collect()}
        assert got == {"a": n, None: n}


def test_auc_of_a_null_group_and_without_keys(spark):
    rows = [(g, y, s) for g in ("x", None) for y, s in ((1.0, 0.9), (0.0, 0.4), (1.0, 0.4), (0.0, 0.1))]
    df = spark.createDataFrame(rows, "g string, y double, s double")
    got = {r.g: r.auc for r in mt.roc_auc(df, F.col("y") > 0.5, "s", ["g"]).collect()}
    assert got == {"x": 0.875, None: 0.875}
    m = mt.two_stage_metrics(df.withColumn("p", F.col("s")), "y", "p", "s", 0.5, [])
    assert m.count() == 1 and m.first()["auc"] == 0.875 and "_one" not in m.columns


def test_params_keep_long_keys_and_big_integers(spark):
    key = "p_" + "k" * 12_000
    df = spark.createDataFrame([({key: "1", "q": "2"}, "12345678901234567890123")], "m map<string,string>, v string")
    r = df.select(rn.strip_prefix(F.col("m"), "p_").alias("m"), rn.typed_param(F.col("v")).alias("t")).first()
    assert list(r.m) == [key[2:]] and r.t.kind == "int" and r.t.int_value is None and r.t.str_value == "12345678901234567890123"
