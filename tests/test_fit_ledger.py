"""A stopped grid goes on with the fits that are left."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pluvio.models import selection as sel
from pluvio.models.fit_ledger import FitLedger, GridUnfinished, data_version, plan, work_off
from pluvio.operators import splits as sp
from pluvio.plans import q_models as qm
from pluvio.series import SeriesSpec
from pluvio.session import scratch_path
from tests.conftest import SF001

SMALL = {"n_estimators": 2, "max_depth": 2}
GRID = {"a": SMALL, "b": {"n_estimators": 3, "max_depth": 2}}


@pytest.fixture(scope="module")
def folded(spark):
    c = qm._clean(spark, SF001)
    f = sp.assign_folds(c, SeriesSpec(keys=("series",), time="fecha"), n_splits=2, test_size=60, min_train_size=200, short="drop")
    return replace(qm._cfg(c), clf_params=SMALL, clf_thr=20.0, reg_thr=20.0, reg_params=SMALL), f.checkpoint()


def table(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_stopped_grid_goes_on(spark, folded, monkeypatch):
    cfg, f = folded
    whole = table(sel.run_grid(f, cfg, GRID, ledger=FitLedger(spark, scratch_path(spark, "fits"))))
    ledger, fits, score = FitLedger(spark, scratch_path(spark, "fits")), [], sel.score_fold

    def counted(staged, fold, *a, **kw):
        if len(fits) == 1:
            fits.append("stopped")
            raise KeyError("stopped")
        fits.append(fold)
        return score(staged, fold, *a, **kw)
    monkeypatch.setattr(sel, "score_fold", counted)
    with pytest.raises(KeyError):
        sel.run_grid(f, cfg, GRID, ledger=ledger, parallelism=1)
    assert ledger.read().count() == 1 and fits[1:] == ["stopped"]
    with pytest.raises(GridUnfinished) as stop:
        sel.run_grid(f, cfg, GRID, ledger=ledger, parallelism=2, limit=2)
    assert stop.value.left == 1 and ledger.read().count() == 3
    assert table(sel.run_grid(f, cfg, GRID, ledger=ledger)) == whole
    n = len(fits)
    assert table(sel.run_grid(f, cfg, GRID, ledger=ledger)) == whole and len(fits) == n == 5  # four fits and the stop
    sel.run_grid(f, cfg, {**GRID, "renamed": SMALL, "c": {"n_estimators": 1, "max_depth": 2}}, ledger=ledger)
    assert len(fits) == n + 2  # only the new parameters, on both folds
    sel.run_grid(f.where("i > 3"), cfg, {"a": SMALL}, ledger=ledger)
    assert len(fits) == n + 4  # other data


def test_regressor_grid_fits_one_classifier_a_fold(spark, folded, monkeypatch):
    cfg, f = folded
    made, fit = [], sel.fit_classifier
    monkeypatch.setattr(sel, "fit_classifier", lambda df, c: made.append(1) or fit(df, c))
    out = sel.run_grid(f, cfg, {"l1": {**SMALL, "objective": "regression_l1"}, "l2": SMALL}, stage="reg", parallelism=4).collect()
    assert len(made) == 2 and sorted(r["rank"] for r in out) == [1, 2]


def test_plan_and_version(spark):
    d = spark.range(50).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    assert data_version(d) == data_version(d.orderBy(F.desc("id")).repartition(7)) == data_version(d.select("v", "id"))
    assert len({data_version(x) for x in (d, d.where("id > 0"), d.unionByName(d.limit(1)), d.withColumn("v", F.col("v") + 1), d.limit(0))}) == 5
    p = plan(spark, "clf", {"a": {"x": 1}, "b": {"x": 2}, "same as a": {"x": 1}}, [1, 2], "v")
    assert p.count() == 6 and p.select("key").distinct().count() == 4
    ledger = FitLedger(spark, scratch_path(spark, "fits"))
    assert len(ledger.missing(p)) == 4 and ledger.read().count() == 0
    assert work_off(ledger, p, lambda row: {"m": 1, "none": None}, parallelism=3) == 4 and work_off(ledger, p, lambda row: 1 / 0) == 0
    got = ledger.results(p).collect()
    assert len(got) == 6 and {r.config for r in got} == {"a", "b", "same as a"} and all(r.metrics == {"m": 1.0, "none": None} for r in got)
    ledger.record(ledger.read().first().asDict(), {"m": 9}, 0.1)  # a second finish of a key
    assert ledger.read().count() == 4 and {r.metrics["m"] for r in ledger.read().collect()} == {1.0}
