"""Features on top of the tail equal those over the whole history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.operators.tail import TailState, rows_back
from pluvio.series import SeriesSpec
from pluvio.session import scratch_path

SPEC = SeriesSpec(keys=("series",), time="fecha")
CFG = fe.FeatureConfig(rename={"rain": "precip"}, lag_vars=["precip", "d2"], lags=(1, 3), rolling_vars=["precip", "d2"], windows=(3, 7), stats=("mean", "max"),
                       diffs={"precip": {"d2": 2}}, wmo_col=None)
SCHEMA = "series string, fecha date, rain double"


def series(days, seed, names=("a", "b", None)):
    """A dry stretch in the middle is longer than any window."""
    rnd = random.Random(seed)
    return [(s, dt.date(2024, 1, 1) + dt.timedelta(days=i), 0.0 if 30 < i < 90 else rnd.choice([0.0, 0.5, 4.0, None]))
            for s in names for i in range(days) if rnd.random() < 0.95]


def rows(df, columns):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(columns).collect()), key=str)


def test_daily_steps_equal_full_recomputation(spark):
    data = series(110, 1)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    full = fe.build_features(spark.createDataFrame(data, SCHEMA), SPEC, CFG)
    columns = [c for c in full.columns if c != CFG.target_name]  # the next row is not known yet
    tail = TailState(spark, scratch_path(spark, "tail"), SPEC, CFG)
    tail.start(spark.createDataFrame([r for r in data if r[1] < day(40)], SCHEMA))
    for lo, hi in ((40, 41), (41, 42), (42, 75), (75, 110)):
        new = spark.createDataFrame([r for r in data if day(lo) <= r[1] < day(hi)], SCHEMA)
        got = tail.advance(new)
        assert rows(got, columns) == rows(full.where((F.col("fecha") >= day(lo)) & (F.col("fecha") < day(hi))), columns)
        assert tail.read().groupBy("series").count().agg(F.max("count")).first()[0] <= rows_back(CFG)
    assert tail.generations() == [0, 1, 2, 3, 4] and tail.prune(2) == [0, 1, 2] and tail.generations() == [3, 4]


def test_new_series_and_empty_start(spark):
    data = series(20, 2, ("new",))
    tail = TailState(spark, scratch_path(spark, "tail"), SPEC, CFG)
    full = fe.build_features(spark.createDataFrame(data, SCHEMA), SPEC, CFG)
    assert rows(tail.advance(spark.createDataFrame(data, SCHEMA)), full.columns) == rows(full, full.columns)
    other = [("late", dt.date(2025, 1, 1), 1.0)]
    got = tail.advance(spark.createDataFrame(other, SCHEMA)).collect()
    assert len(got) == 1 and got[0].racha_seca == 0 and {r.series for r in tail.read().select("series").distinct().collect()} == {"new", "late"}


@pytest.mark.parametrize("lost", ["_SUCCESS"])
def test_incomplete_generation_is_not_read(spark, lost):
    tail = TailState(spark, scratch_path(spark, "tail"), SPEC, CFG)
    tail.start(spark.createDataFrame(series(30, 3), SCHEMA))
    n = tail.read().count()
    spark.createDataFrame(series(5, 4), SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tail.path}/gen=1")
    assert tail.generations() == [0] and tail.read().count() == n
    tail.advance(spark.createDataFrame([("a", dt.date(2024, 3, 1), 0.0)], SCHEMA))
    assert tail.generations() == [0, 1] and tail.read().where("series = 'a'").agg(F.max("fecha")).first()[0] == dt.date(2024, 3, 1)


def test_daily_flow_on_the_tail_stores_the_same_scores(spark):
    """The last predictions equal those from the features of the whole history."""
    from pluvio.flows import daily_flow
    from pluvio.plans import bindings as b
    from pluvio.plans import q_features as qf
    from pluvio.plans import q_models as qm
    from tests.conftest import SF001
    got = {(r.series, r.fecha): (r.prob_rain, r.mm_predicted) for r in qm.q_daily_flow_tail(spark, SF001).collect()}
    c = qm._clean(spark, SF001)
    full = daily_flow(spark, qf._feature_table(spark, SF001), qm.fit_two_stage(c, qm._cfg(c)), scratch_path(spark, "store"), ["series"], "precip", "v1", qm.WET)
    want = {(r.series, r.fecha): (r.prob_rain, r.mm_predicted) for r in full.collect()}
    end = b.daily_lineitem(spark, SF001).agg(F.max("fecha")).first()[0]
    late = {k: v for k, v in want.items() if k[1] > end - dt.timedelta(days=15)}
    assert late and all(abs(got[k][0] - v[0]) < 1e-9 and abs(got[k][1] - v[1]) < 1e-9 for k, v in late.items())
