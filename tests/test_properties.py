"""SURVEY §5 properties: independent of partitioning and input order; short
series; fold bounds for random lengths; unmatched actuals on the dashboard."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.operators import monitor as mo
from pluvio.operators import splits as sp
from pluvio.series import SeriesSpec
from tests.test_splits import expected_bounds


def _series(spark):
    rows = [(s, dt.date(2021, 1, 1) + dt.timedelta(days=i), float((i * (2 + k)) % 6))
            for k, s in enumerate(["a", "b", "c"]) for i in range(120)]
    return spark.createDataFrame(rows, "series string, fecha date, precip double")


CFG = fe.FeatureConfig(rename={}, lag_vars=["precip"], rolling_vars=["precip"], windows=(7, 30),
                       streak_col="precip", streak_threshold=2.0, target_col="precip", wmo_col=None)


def test_independent_of_partitioning_and_order(spark):
    df = _series(spark)
    spec = SeriesSpec(keys=("series",), time="fecha")
    a = fe.build_features(df.coalesce(1), spec, CFG)
    b = fe.build_features(df.repartition(7).orderBy(F.rand(3)), spec, CFG)
    c = fe.build_features(df.repartition(5), SeriesSpec(keys=("series",), time="fecha", chunk_rows=31), CFG)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_short_series(spark):
    rows = [("s", dt.date(2021, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "series string, fecha date, precip double")
    out = fe.build_features(df, SeriesSpec(keys=("series",), time="fecha"), CFG).orderBy("fecha").collect()
    assert all(r["precip_rmean_7"] is None for r in out)
    assert [r["racha_seca"] for r in out] == [0, 1, 2, 3, 0]   # dry while previous value <= 2
    assert out[-1]["precip_t1"] is None
    lengths = spark.createDataFrame([("s", 5)], "series string, n long")
    assert sp.fold_bounds(lengths, ["series"], 5, 365, 1095, short="drop").count() == 0


@settings(max_examples=12, deadline=None)
@given(n=st.integers(1, 60), k=st.integers(1, 6), strategy=st.sampled_from(["expanding", "sliding"]))
def test_fold_bounds_property(spark, n, k, strategy):
    lengths = spark.createDataFrame([("s", n)], "series string, n long")
    got = sorted(tuple(r) for r in sp.fold_bounds(lengths, ["series"], k, 4, 10, strategy, short="drop")
                 .select("fold", "train_lo", "train_hi", "test_hi").collect())
    exp = expected_bounds(n, k, 4, 10, strategy)
    assert got == exp
    for _, lo, hi, te in got:   # ordered, disjoint train/test, exact test size, inside the series
        assert 0 <= lo < hi < te <= n and te - hi == 4


def test_unmatched_actuals_dashboard(spark):
    base = dt.date(2024, 3, 1)
    act = spark.createDataFrame([(base + dt.timedelta(i), float(i % 5), int(i % 5 > 2)) for i in range(20)],
                                "fecha date, mm_actual double, did_rain int")
    pred = spark.createDataFrame([(base + dt.timedelta(i), 0.7, float(i % 4), 1, "v1") for i in range(0, 20, 2)],
                                 "fecha date, prob_rain double, mm_predicted double, will_rain int, model_version string")
    pairs = mo.forecast_vs_actual(act, pred)
    assert pairs.count() == 20 and pairs.filter(F.col("mm_predicted").isNull()).count() == 10
    s = mo.dashboard_series(pairs)
    assert s.filter(F.col("error").isNull()).count() == 10
    m = mo.dashboard_metrics(s).first()
    assert m["n_days"] == 10   # only complete pairs count; no NaN leaks into the mean
    exp_err = [abs(float(i % 4) - float(i % 5)) for i in range(0, 20, 2)]
    assert m["mae"] == round(sum(exp_err) / 10, 3)
