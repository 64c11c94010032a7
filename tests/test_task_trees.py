"""Trees grown in one task are those that MLlib grows by jobs."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from pluvio.models import selection as sel
from pluvio.models import task_trees as tt
from pluvio.operators import metrics as mt
from pluvio.operators import splits as sp
from pluvio.plans import q_models as qm
from pluvio.series import SeriesSpec
from tests.conftest import SF001

KNOBS = dict(featuresCol="features", labelCol="y", maxIter=6, maxDepth=4, stepSize=0.2, minInstancesPerNode=5, subsamplingRate=0.8,
             featureSubsetStrategy="0.6", seed=42)


def points(spark, n=700, parts=3):
    """Features with many values, with few, with zeros, and a constant one."""
    r = np.random.default_rng(7)
    x = r.normal(size=(n, 8))
    x[:, 2], x[:, 3], x[:, 4], x[:, 5] = np.round(x[:, 2]), x[:, 3] > 0.5, np.maximum(x[:, 4], 0), 1.0
    t = x[:, 0] + x[:, 1] * x[:, 2] + r.normal(size=n)
    rows = [(*map(float, a), float(b > 0), float(b)) for a, b in zip(x, t)]
    names = [f"x{i}" for i in range(8)]
    d = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), ", ".join(f"{c} double" for c in [*names, "c", "t"]))
    return VectorAssembler(inputCols=names, outputCol="features").transform(d).checkpoint()


def splits(text: str) -> list[tuple]:
    return [(int(f), float(c)) for f, c in re.findall(r"If \(feature (\d+) <= ([-\dE.]+)\)", text)]


def grown(t: dict, m: int) -> list[tuple]:
    """Splits of a tree in the order of MLlib's text, equal leaves joined as there."""
    s = t["start"][m]

    def below(i):
        if t["feature"][s + i] < 0:
            return [], t["value"][s + i]
        (a, x), (b, y) = below(t["left"][s + i]), below(t["left"][s + i] + 1)
        if not a and not b and x is not None and x == y:
            return [], x
        return [(int(t["feature"][s + i]), float(t["cut"][s + i])), *a, *b], None
    return below(0)[0]


def same_trees(ours, theirs):
    t = tt.unpacked(ours.trees)
    assert len(t["start"]) == len(theirs.trees) and list(t["weight"]) == list(theirs.treeWeights)
    assert [grown(t, m) for m in range(len(t["start"]))] == [splits(x.toDebugString) for x in theirs.trees]


def near(ours, theirs, d, column):
    a, b = ([r[0] for r in m.transform(d).select(column).collect()] for m in (ours, theirs))
    assert np.allclose(a, b, rtol=0, atol=1e-12)


@pytest.mark.parametrize("parts", [1, 3])
def test_classifier_equals_mllib(spark, parts):
    d = points(spark, parts=parts).withColumns({"y": F.col("c"), "w": F.when(F.col("c") == 1, 0.37).otherwise(1.0)})
    ours, theirs = (e(weightCol="w", **KNOBS).fit(d) for e in (tt.TaskGBTClassifier, GBTClassifier))
    same_trees(ours, theirs)
    near(ours, theirs, d, vector_to_array("probability")[1])
    near(ours, theirs, d, vector_to_array("rawPrediction")[0])
    near(ours, theirs, d, F.col("prediction"))


@pytest.mark.parametrize("loss", ["absolute", "squared"])
def test_regressor_equals_mllib(spark, loss):
    d = points(spark).withColumn("y", F.col("t"))
    ours, theirs = (e(lossType=loss, **KNOBS).fit(d) for e in (tt.TaskGBTRegressor, GBTRegressor))
    same_trees(ours, theirs)
    near(ours, theirs, d, F.col("prediction"))


@pytest.mark.parametrize("weight", [0.0, 4.0])
def test_one_class_only(spark, weight):
    d = points(spark, 60).withColumns({"y": F.lit(1.0), "w": F.lit(weight)})
    ours, theirs = (e(weightCol="w", **KNOBS).fit(d) for e in (tt.TaskGBTClassifier, GBTClassifier))
    near(ours, theirs, d, vector_to_array("probability")[1])


def test_what_is_for_mllib_raises(spark):
    d = points(spark, 60).withColumn("y", F.col("c"))
    with pytest.raises(ValueError, match="for MLlib"):
        tt.TaskGBTClassifier(minInfoGain=0.1, **KNOBS).fit(d)
    with pytest.raises(Exception, match="cannot be fitted"):
        tt.TaskGBTClassifier(**KNOBS).fit(d.withColumn("y", F.col("c") + 1))


def test_grid_grows_its_trees_in_tasks_with_mllibs_results(spark, monkeypatch):
    """A grid over small folds takes few jobs and ranks as MLlib's trees do."""
    c = qm._clean(spark, SF001)
    f = sp.assign_folds(c, SeriesSpec(keys=("series",), time="fecha"), n_splits=2, test_size=60, min_train_size=200, short="drop").checkpoint()
    cfg = qm._cfg(c, clf_thr=20.0, reg_thr=20.0, clf_params={"n_estimators": 6, "max_depth": 3}, reg_params={"n_estimators": 3, "max_depth": 2})
    entries = {"a": {"n_estimators": 6, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8}}

    def run(stage):
        before = last_job(spark)
        rows = sel.run_grid(f, cfg, entries, stage=stage).collect()
        return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows], last_job(spark) - before
    ours = {s: run(s) for s in ("clf", "reg")}
    monkeypatch.setattr(sel, "MOST_ROWS", 0)
    theirs = {s: run(s) for s in ("clf", "reg")}
    assert all(ours[s][0] == theirs[s][0] for s in ours)
    assert all(ours[s][1] < theirs[s][1] - 40 for s in ours)


def last_job(spark) -> int:
    """Number of the newest job."""
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_auc_of_few_rows(spark):
    d = spark.range(500).select((F.rand(1) > 0.4).cast("double").alias("y"), F.round(F.rand(2), 2).alias("p"), (F.col("id") % 3).alias("k"))
    for keys in ([], ["k"]):
        a, b = (sorted(map(tuple, mt.roc_auc(d, F.col("y") > 0, "p", keys, few).collect())) for few in (True, False))
        assert a == b and len(a) == (3 if keys else 1)
