"""Model invariants: probability in [0,1], amounts >= 0, prob <= thr ⇒ 0,
save/load gives equal predictions, unmapped knobs raise."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pluvio.flows import monthly_flow
from pluvio.models.registry import live_metadata, load_from_run, load_live, publish
from pluvio.models import grids
from pluvio.models.selection import retrain, run_cv, run_grid
from pluvio.models.two_stage import WEIGHT_KNOBS, TwoStageConfig, TwoStageModel, fit_classifier, fit_two_stage, gbt_params, positive_weight, regressor
from pluvio.operators import runs as rn
from pluvio.operators import splits as sp
from pluvio.plans import q_models as qm
from pluvio.series import SeriesSpec
from pluvio.session import scratch_path
from tests.conftest import SF001


@pytest.fixture(scope="module")
def fitted(spark):
    c = qm._clean(spark, SF001)
    cfg = qm._cfg(c)
    return c, fit_two_stage(c, cfg)


def test_hurdle_invariants(spark, fitted):
    c, m = fitted
    out = m.transform(c)
    r = out.agg(F.min("prob").alias("pmin"), F.max("prob").alias("pmax"), F.min("mm").alias("mmin"),
                F.min("y_hat").alias("ymin"),
                F.count_if((F.col("prob") <= m.cfg.threshold) & (F.col("y_hat") != 0)).alias("leak")).first()
    assert 0.0 <= r["pmin"] <= r["pmax"] <= 1.0
    assert r["mmin"] >= 0 and r["ymin"] >= 0 and r["leak"] == 0


def test_save_load_same_predictions(spark, fitted):
    c, m = fitted
    path = scratch_path(spark, "test-model")
    m.save(path)
    m2 = TwoStageModel.load(spark, path)
    a = m.transform(c).select("series", "fecha", F.col("y_hat").alias("a"))
    b = m2.transform(c).select("series", "fecha", F.col("y_hat").alias("b"))
    assert a.join(b, ["series", "fecha"]).filter(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_knob_mapping(spark):
    p = gbt_params({"n_estimators": 10, "learning_rate": 0.05, "max_depth": 4, "subsample": 0.8,
                    "colsample_bytree": 0.7, "num_leaves": 31, "verbose": -1})
    assert p == {"maxIter": 10, "stepSize": 0.05, "maxDepth": 4, "subsamplingRate": 0.8,
                 "featureSubsetStrategy": "0.7", "seed": 42}
    assert gbt_params({"num_leaves": 7})["maxDepth"] == 3 and gbt_params({"num_leaves": 7, "max_depth": 2})["maxDepth"] == 2
    for knob in ("gamma_knob", "reg_alpha", "scale_pos_weight", "objective", "drop_rate"):
        with pytest.raises(ValueError):
            gbt_params({knob: 1})
    with pytest.raises(ValueError):
        gbt_params({"boosting_type": "dart"})
    with pytest.raises(ValueError):
        regressor({"objective": "quantile", "alpha": 0.85}, "y")


def test_objectives_choose_the_estimator(spark):
    assert regressor({"objective": "regression_l1"}, "y").getLossType() == "absolute"
    assert regressor({}, "y").getLossType() == "squared"
    assert regressor({"objective": "huber", "alpha": 1.5}, "y").getEpsilon() == 1.5
    t = regressor({"objective": "tweedie", "tweedie_variance_power": 1.3}, "y")
    assert t.getFamily() == "tweedie" and t.getVariancePower() == 1.3


def test_positive_weights_change_the_fit(fitted):
    c, m = fitted
    probs = []
    for w in (4.0, 6.0):
        cfg = replace(m.cfg, clf_params={**m.cfg.clf_params, "scale_pos_weight": w})
        assert positive_weight(c, cfg) == w
        probs.append(TwoStageModel(cfg, fit_classifier(c, cfg), None).predict_proba(c).agg(F.avg("prob")).first()[0])
    assert probs[0] < probs[1]
    assert positive_weight(c, replace(m.cfg, clf_params={"is_unbalance": False})) == 1.0


def test_missing_regressor_is_an_error(spark, fitted):
    import shutil
    c, m = fitted
    path = scratch_path(spark, "test-model")
    m.save(path)
    local = path.removeprefix("file:")
    shutil.move(f"{local}/reg", f"{local}/elsewhere")
    with pytest.raises(Exception):
        TwoStageModel.load(spark, path)
    TwoStageModel(m.cfg, m.clf, None).save(path)
    assert TwoStageModel.load(spark, path).reg is None


def test_cv_takes_any_model(spark, fitted):
    c, m = fitted

    class Mean:
        def __init__(self, y):
            self.y = y

        def transform(self, df):
            return df.withColumn("y_hat", F.lit(self.y))

    folded = sp.assign_folds(c, SeriesSpec(keys=("series",), time="fecha"), n_splits=2, test_size=50, min_train_size=200, short="drop")
    out = run_cv(folded, m.cfg.features, m.cfg.label, fit=lambda tr, f, lab, p: Mean(tr.agg(F.avg(lab)).first()[0]))
    rows = {r.fold: r for r in out.collect()}
    assert set(rows) == {"1", "2", "promedio"} and rows["1"].test_size == folded.where("fold = 1 AND role = 'test'").count()
    assert rows["1"].train_end <= rows["1"].test_end and rows["promedio"].train_size is None


def test_monthly_flow_logs_what_happened(spark):
    d0 = dt.date(2024, 3, 1)
    days = [d0 + dt.timedelta(i) for i in range(30)]
    actual = [(s, d, 10.0, 1, dt.datetime(2024, 4, 1)) for s in ("bad", "good") for d in days]
    pred = [(s, d, 0.9, 0.0 if s == "bad" else 10.0, 1, "v1", dt.datetime(2024, 4, 1)) for s in ("bad", "good") for d in days]
    seen = []

    def run(retrainer):
        root = scratch_path(spark, "test-flow")
        spark.createDataFrame(actual, "series string, fecha date, mm_actual double, did_rain int, recorded_at timestamp").write.parquet(f"{root}/actuals")
        spark.createDataFrame(pred, "series string, fecha date, prob_rain double, mm_predicted double, will_rain int, model_version string, "
                                    "predicted_at timestamp").write.parquet(f"{root}/predictions")
        feats = spark.createDataFrame([("bad", d0), ("good", d0)], "series string, fecha date")
        out = monthly_flow(spark, root, ["series"], dt.date(2024, 3, 31), feats, TwoStageConfig(features=[]), retrainer=retrainer)
        return {r.notes.split(" | ")[0]: (r.degraded, r.retrained, r.new_model_version, r.notes.split(" | ")[1]) for r in out.collect()}

    def won(spark, root, rows, keys, cfg, current, version):
        seen.append((current, [r.series for r in rows.collect()]))
        return {"rmse_new": 1.0, "promote": True, "version": "20240401_0000"}

    got = run(won)
    assert seen == [(10.0, ["bad"])]
    assert got["good"] == (0, 0, None, "no degradation")
    assert got["bad"] == (1, 1, "20240401_0000", "challenger rmse=1.000 against 10.000; published 20240401_0000")
    lost = run(lambda *a: {"rmse_new": 20.0, "promote": False, "version": None})
    assert lost["bad"][:3] == (1, 0, None) and lost["bad"][3].endswith("kept current")

    def broken(*a):
        raise RuntimeError("no rows")
    failed = run(broken)
    assert failed["bad"] == (1, 0, None, "retraining failed: RuntimeError: no rows") and failed["good"][0] == 0


def test_retrain_publishes_only_a_better_model(spark, fitted):
    c, m = fitted
    root = scratch_path(spark, "test-store")
    publish(spark, root, m, c, "20200101_0000")
    assert retrain(spark, root, c, ["series"], m.cfg, -1.0, "20200102_0000", holdout=30)["version"] is None
    assert live_metadata(spark, root).first()["version"] == "20200101_0000"
    assert retrain(spark, root, c, ["series"], m.cfg, 1e9, "20200103_0000", holdout=30)["version"] == "20200103_0000"
    live = live_metadata(spark, root).first()
    assert live["version"] == "20200103_0000" and live["n_samples"] == c.count()
    row = c.first().asDict()
    one = load_live(spark, root).predict_one(spark, row)
    assert 0 <= one["prob"] <= 1 and one["y_hat"] >= 0


def test_publish_is_atomic(spark, fitted, monkeypatch):
    """Two publishes of one minute both stay; a stop between the writes leaves
    the old model live; an earlier one can be taken live again."""
    from pluvio.models import registry as rg
    c, m = fitted
    root, other = scratch_path(spark, "test-store"), TwoStageModel(replace(m.cfg, threshold=0.9), m.clf, m.reg)
    first = publish(spark, root, m, c, "20240101_0000").first()
    second = publish(spark, root, other, c, "20240101_0000").first()
    assert first["path"] != second["path"] and load_live(spark, root).cfg.threshold == 0.9
    assert TwoStageModel.load(spark, first["path"]).cfg == m.cfg
    third = TwoStageModel(replace(m.cfg, threshold=0.7), m.clf, m.reg)

    def stopped(*a):
        raise RuntimeError("stopped")
    for name in ("point_to", "metadata"):
        with monkeypatch.context() as mp:
            mp.setattr(rg, name, stopped)
            with pytest.raises(RuntimeError):
                publish(spark, root, third, c, "20240102_0000")
        assert live_metadata(spark, root).first()["threshold"] == 0.9
    rg.point_to(spark, root, first["version"], first["content"])
    assert load_live(spark, root).cfg == m.cfg
    assert publish(spark, root, third, c, "20240102_0000").count() == 1 and load_live(spark, root).cfg.threshold == 0.7
    assert live_metadata(spark, root).count() == 1
    publish(spark, root, other, c, "20240101_0000")  # known: pointed to again, one metadata row
    assert load_live(spark, root).cfg.threshold == 0.9 and rg.metadata(spark, root).where("threshold = 0.9").count() == 1
    with pytest.raises(ValueError):
        rg.point_to(spark, root, "20990101_0000", "none")


def test_runs_are_logged_and_load_their_model(spark, fitted):
    c, m = fitted
    base = scratch_path(spark, "test-runs")
    m.save(f"{base}/model")
    fm = spark.createDataFrame([(1, 2.0, None), (2, 4.0, 0.5)], "fold int, rmse double, r2 double")
    rn.append_runs(rn.cv_runs(fm, "fold", ["rmse", "r2"], "a", {"stage": "cv", "model_path": f"{base}/model"}, {"depth": 3}), f"{base}/runs")
    rn.append_runs(rn.cv_runs(fm.where("fold = 1"), "fold", ["rmse", "r2"], "b", {"stage": "cv"}), f"{base}/runs")
    runs = rn.read_runs(spark, f"{base}/runs")
    got = {r.run_id: (r.parent_run_id, r.metrics) for r in runs.collect()}
    assert got["a-parent"] == (None, {"cv_avg_rmse": 3.0, "cv_avg_r2": 0.5}) and got["a-1"] == ("a-parent", {"rmse": 2.0}) and len(got) == 5
    best = rn.best_per_group(runs.where("parent_run_id IS NULL"), F.col("tags")["stage"], "cv_avg_rmse").first()
    assert best.run_id == "b-parent"
    loaded = load_from_run(spark, runs, "a-parent")
    assert loaded.cfg == m.cfg
    with pytest.raises(ValueError):
        load_from_run(spark, runs, "b-parent")


def test_grid_entries_are_distinct_models(spark):
    clf = {n: (tuple(sorted(gbt_params(p, WEIGHT_KNOBS).items())), p.get("scale_pos_weight"), p.get("is_unbalance")) for n, p in grids.CLASSIFIERS.items()}
    assert len(set(clf.values())) == len(clf)
    for p in grids.REGRESSORS.values():
        regressor({k: v for k, v in p.items() if k != "log_target"}, "y")


def test_classifier_grid_ranks_and_regressor_grid_orders_by_error(spark, fitted):
    c, m = fitted
    folded = sp.assign_folds(c, SeriesSpec(keys=("series",), time="fecha"), n_splits=2, test_size=60, min_train_size=200, short="drop")
    small = {"n_estimators": 2, "max_depth": 2}
    out = run_grid(folded, replace(m.cfg, clf_params=small, clf_thr=20.0, reg_thr=20.0), {"l1": {**small, "objective": "regression_l1"}, "l2": small}, stage="reg").collect()
    by_rank = sorted(out, key=lambda r: r["rank"])
    assert [r["rank"] for r in by_rank] == [1, 2] and by_rank[0]["avg_rmse_rain"] <= by_rank[1]["avg_rmse_rain"]


def test_grid_and_cv_queries_take_every_entry_and_five_folds(spark, fitted, monkeypatch):
    c, seen, folds = fitted[0], [], []

    def assign(df, spec, n_splits, **kw):
        folds.append(n_splits)
        return df.limit(1)

    def grid(folded, cfg, entries, stage, **kw):
        seen.append((stage, entries))
        return folded

    def cv(folded, *a, **kw):
        return folded
    monkeypatch.setattr(qm, "_clean", lambda *a: c)
    monkeypatch.setattr(qm.sp, "assign_folds", assign)
    monkeypatch.setattr(qm, "run_grid", grid)
    monkeypatch.setattr(qm, "run_cv", cv)
    monkeypatch.setattr(qm, "run_cv_two_stage", cv)
    for q in (qm.q_clf_grid, qm.q_reg_grid, qm.q_cv_single_stage, qm.q_cv_two_stage):
        q(spark, SF001)
    assert seen == [("clf", grids.CLASSIFIERS), ("reg", grids.REGRESSORS)] and folds == [5] * 4


def test_importance_of_a_model_without_splits(spark, fitted):
    """All rows wet: one class, so no tree splits and no feature has a share."""
    from pluvio.models.registry import importance_table, write_importance_csv
    c, m = fitted
    wet = c.withColumn(m.cfg.label, F.col(m.cfg.label) + 1000.0)
    table = importance_table(spark, fit_two_stage(wet, m.cfg), top_n=10)
    rows = table.collect()
    assert len(rows) == len(m.cfg.features) and all(r.importance == 0.0 and r.importance_pct is None and r.top_pct is None for r in rows)
    path = scratch_path(spark, "importance")
    write_importance_csv(table, path)
    assert spark.read.option("header", True).csv(path).count() == min(30, len(rows))
    shares = importance_table(spark, m, top_n=3).agg(F.sum("importance_pct"), F.sum("top_pct")).first()
    assert abs(shares[0] - 100) < 0.5 and abs(shares[1] - 100) < 1e-9
