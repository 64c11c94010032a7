"""Metrics vs brute force / numpy on golden micro-tables."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import metrics as mt


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a]
    neg = [b for a, b in zip(y, s) if not a]
    if not pos or not neg:
        return None
    return sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))


def test_auc_ties_and_one_class(spark):
    rows = [("g", 1, 0.9), ("g", 0, 0.9), ("g", 1, 0.5), ("g", 0, 0.2), ("g", 0, 0.5), ("g", 1, 0.7),
            ("h", 1, 0.3), ("h", 1, 0.4)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["auc"] for r in mt.roc_auc(df, F.col("y") == 1, "s", ["g"]).collect()}
    g = [r for r in rows if r[0] == "g"]
    assert got["g"] == pytest.approx(brute_auc([r[1] for r in g], [r[2] for r in g]))
    assert got["h"] is None


def test_auc_random_vs_brute(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    got = mt.roc_auc(df, F.col("y") == 1, "s").first()["auc"]
    assert got == pytest.approx(brute_auc(list(y), list(s)))


def test_regression_and_classification(spark):
    y = [0.0, 2.0, 5.0, 0.0, 1.5, 30.0]
    p = [0.5, 1.0, 7.0, 0.0, 0.0, 10.0]
    df = spark.createDataFrame(list(zip(y, p)), "y double, p double")
    r = mt.evaluate(df, "y", "p").first()
    ya, pa = np.array(y), np.array(p)
    assert r["mae"] == pytest.approx(np.mean(np.abs(ya - pa)))
    assert r["rmse"] == pytest.approx(math.sqrt(np.mean((ya - pa) ** 2)))
    assert r["r2"] == pytest.approx(1 - np.sum((ya - pa) ** 2) / np.sum((ya - ya.mean()) ** 2))
    nz = ya != 0
    assert r["mape"] == pytest.approx(np.mean(np.abs((ya[nz] - pa[nz]) / ya[nz])) * 100)
    assert (r["true_positives"], r["false_positives"], r["true_negatives"], r["false_negatives"]) == (2, 0, 2, 2)


def test_no_wet_days_zero_division(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.1)] * 20, "y double, p double, prob double")
    r = df.agg(*mt.two_stage_aggs("y", "p", "prob", 0.3)).first()
    assert r["precision"] == 0.0 and r["recall"] == 0.0 and r["fbeta"] == 0.0
    assert r["mae_rain"] is None and r["recall_picos"] is None and r["n_lluvia"] == 0
    assert r["r2"] == 1.0  # constant target predicted perfectly
    r2 = mt.evaluate(df, "y", "p").first()
    assert r2["mape"] is None and r2["f1_score"] == 0.0


def test_best_threshold_first_wins(spark):
    # all candidate thresholds give the same F-beta → the first one wins
    df = spark.createDataFrame([(1.0, 0.9), (0.0, 0.1), (1.0, 0.8)], "y double, prob double")
    r = mt.best_threshold(df, "y", "prob").first()
    assert r["best_threshold"] == 0.2 and r["best_fbeta"] == pytest.approx(1.0)


def test_fold_summary_is_mean_of_folds(spark):
    fm = spark.createDataFrame([(1, 1.0, 10.0), (2, 3.0, 20.0), (3, 5.0, None)], "fold int, mae double, rmse double")
    rows = {r["fold"]: r for r in mt.fold_summary(fm, ["mae", "rmse"]).collect()}
    assert rows["promedio"]["mae"] == pytest.approx(3.0) and rows["promedio"]["rmse"] == pytest.approx(15.0)
    assert rows["2"]["mae"] == 3.0


def test_grid_mode_smallest_of_ties(spark):
    fm = spark.createDataFrame([("a", 0.3, 0.5), ("a", 0.2, 0.7), ("a", 0.4, 0.6), ("a", 0.3, 0.4), ("a", 0.2, 0.5)],
                               "config string, threshold double, fbeta double")
    r = mt.grid_summary(fm, "config", ["fbeta"], ["fbeta"]).first()
    assert r["best_threshold"] == 0.2
    assert r["robust_score"] == pytest.approx(np.mean([.5, .7, .6, .4, .5]) - np.std([.5, .7, .6, .4, .5], ddof=1))
