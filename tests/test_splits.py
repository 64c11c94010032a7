"""Fold bounds vs the positional rule; folds disjoint, ordered, exact sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.operators import splits as sp
from pluvio.series import SeriesSpec


def expected_bounds(n, k, test, min_train, strategy):
    if n < min_train + test:
        return []
    room = n - test - min_train
    step = room // (k - 1) if k > 1 else 0
    out = []
    for i in range(k):
        off = room if i == k - 1 else i * step
        lo = 0 if strategy == "expanding" else off
        if off + min_train + test > n:
            break
        out.append((i + 1, lo, off + min_train, off + min_train + test))
    return out


@pytest.mark.parametrize("strategy", ["expanding", "sliding"])
@pytest.mark.parametrize("n,k", [(30, 1), (30, 2), (30, 5), (47, 5), (25, 3), (24, 3), (100, 4)])
def test_fold_bounds(spark, strategy, n, k):
    lengths = spark.createDataFrame([("s", n)], "series string, n long")
    got = sorted(tuple(r) for r in sp.fold_bounds(lengths, ["series"], k, 5, 20, strategy, short="drop")
                 .select("fold", "train_lo", "train_hi", "test_hi").collect())
    assert got == expected_bounds(n, k, 5, 20, strategy)


def test_assign_folds_roles(spark):
    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=i)) for s, n in (("a", 40), ("b", 33), ("c", 10)) for i in range(n)]
    df = spark.createDataFrame(rows, "series string, fecha date")
    f = sp.assign_folds(df, SeriesSpec(keys=("series",), time="fecha"), n_splits=3, test_size=5, min_train_size=20,
                        strategy="expanding", short="drop")
    ext = {(r["series"], r["fold"], r["role"]): r for r in sp.fold_extent(f, ["series"], "fecha").collect()}
    assert not any(k[0] == "c" for k in ext)               # too short: no folds
    for s in ("a", "b"):
        for fold in (1, 2, 3):
            tr, te = ext[(s, fold, "train")], ext[(s, fold, "test")]
            assert te["n"] == 5 and tr["end"] < te["start"]
    assert ext[("a", 3, "test")]["end"] == dt.date(2020, 1, 1) + dt.timedelta(days=39)


def test_train_test_split_and_last_rows(spark):
    rows = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(37)]
    df = spark.createDataFrame(rows, "series string, fecha date, v double")
    spec = SeriesSpec(keys=("series",), time="fecha")
    s = sp.train_test_split(df, spec)
    assert s.filter(F.col("role") == "train").count() == int(37 * 0.8)
    assert sp.last_rows(df, spec, 7).agg(F.min("v")).first()[0] == 30.0
    assert sp.last_rows(df, spec, 7, tail=False).count() == 30


def test_dense_index_single_series_no_single_partition_window(spark):
    """The dense index of a keyless series must not shuffle all rows into one task."""
    from pluvio.series import dense_index
    df = spark.range(5000).select(F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("fecha"))
    d = dense_index(df, SeriesSpec(keys=(), time="fecha"))
    assert sorted(r[0] for r in d.select("_pv_i").collect()) == list(range(5000))
    plan = d._jdf.queryExecution().executedPlan().toString()
    # the only single-partition window is over the per-month count table, never over data rows
    assert plan.count("SinglePartition") <= 1


def test_range_index_hot_month_is_split(spark):
    """A keyless series with a third of its rows inside one month (minute
    grain) is numbered exactly, by range partitions rather than one window
    task per calendar month."""
    from pyspark.sql import Window
    from pluvio.series import dense_index
    base = dt.datetime(2001, 1, 1)
    spread = spark.range(4000).select(
        F.timestamp_add("HOUR", (F.col("id") * 7).cast("int"), F.lit(base)).alias("ts"))
    hot = spark.range(2000).select(
        F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit(dt.datetime(2003, 6, 1))).alias("ts"))
    df = spread.unionByName(hot).withColumn("v", F.rand(7))
    d = dense_index(df, SeriesSpec(keys=(), time="ts"))
    want = d.withColumn("rk", F.row_number().over(Window.orderBy("ts")) - 1)
    assert want.filter(F.col("rk") != F.col("_pv_i")).count() == 0
    assert d.select("_pv_i").distinct().count() == 6000
    # the hot month is spread over several range partitions
    per_part = (df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "ts")
                .filter(F.month("ts") == 6).groupBy(F.spark_partition_id()).count())
    assert per_part.count() > 1


def test_range_index_keyed_hot_series(spark):
    """Chunked plan with keys: one series holds most rows, all inside one
    month at minute grain; every series is numbered exactly and the hot
    series is spread over several range partitions."""
    from pyspark.sql import Window
    from pluvio.series import dense_index
    hot = spark.range(3000).select(F.lit("hot").alias("s"),
                                   F.timestamp_add("MINUTE", F.col("id").cast("int"),
                                                   F.lit(dt.datetime(2004, 2, 1))).alias("ts"))
    cold = spark.range(1500).select((F.col("id") % 3).cast("string").alias("s"),
                                    F.timestamp_add("HOUR", F.col("id").cast("int"),
                                                    F.lit(dt.datetime(2004, 1, 1))).alias("ts"))
    df = hot.unionByName(cold)
    d = dense_index(df, SeriesSpec(keys=("s",), time="ts", chunk_rows=500))
    want = d.withColumn("rk", F.row_number().over(Window.partitionBy("s").orderBy("ts")) - 1)
    assert want.filter(F.col("rk") != F.col("_pv_i")).count() == 0
    assert d.count() == 4500
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = (df.repartitionByRange(n, "s", "ts").filter(F.col("s") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_keyless_split_positions_and_length(spark):
    """One series without keys: positions from the range index, length from
    the same layout; split and tail rows as for a keyed series."""
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(37)]
    df = spark.createDataFrame(rows, "fecha date, v double")
    spec = SeriesSpec(keys=(), time="fecha")
    p = sp.with_position(df, spec)
    got = sorted((r["i"], r["n"], r["v"]) for r in p.collect())
    assert got == [(i, 37, float(i)) for i in range(37)]
    s = sp.train_test_split(df, spec)
    assert s.filter(F.col("role") == "train").agg(F.max("v")).first()[0] == float(int(37 * 0.8) - 1)
    assert sp.last_rows(df, spec, 7).agg(F.min("v")).first()[0] == 30.0
