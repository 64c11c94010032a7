"""Queries: model fitting, CV, grids, scoring, retraining and persistence
(ML5-ML16, PRJ5, SNK6-7, SRC7, UDF3). Fixed seeds; no SQL oracle (the
driver runs its rows-only check); invariants are covered in tests."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from pluvio.models import grids
from pluvio.models import registry as reg
from pluvio.models.fit_ledger import FitLedger, GridUnfinished
from pluvio.models.selection import retrain_and_compare, run_cv, run_cv_two_stage, run_grid
from pluvio.models.stages import TwoStageEstimator
from pluvio.models.two_stage import TwoStageConfig, TwoStageModel, fit_single_stage, fit_two_stage
from pluvio.operators import splits as sp
from pluvio.operators.store import latest_by_key
from pluvio.operators.tail import TailState
from pluvio.plans import bindings as b
from pluvio.plans import q_features as qf
from pluvio.plans.registry import present, query
from pluvio.session import checkpoint_dir, materialize, scratch_path, tune_optimizer

SMALL = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3, "random_state": 42}
WET = b.D_DRY_THRESHOLD
PEAK = 250.0
GRID_THREADS = 8  # fits that run at the same time


def _clean(spark, sf_dir):
    """Clean feature rows, checkpointed into the shared checkpoint folder:
    every boosting iteration then starts from those files instead of
    re-planning and re-running the feature pipeline."""
    tune_optimizer(spark)
    checkpoint_dir(spark)
    return qf._feature_table(spark, sf_dir).na.drop("any").checkpoint()


def _features(df):
    """PRJ4 — model inputs by exclusion: all columns but the renamed raw daily
    names, the target and the series key/time (same-day aggregates stay in)."""
    from pluvio.operators.features import feature_names
    return feature_names(df, qf.D_CFG, keys=("series", "fecha"))


def _cfg(df, **kw):
    base = dict(features=_features(df), label="precip_t1", clf_params=SMALL, reg_params=SMALL,
                threshold=0.3, log_target=True, clf_thr=WET, reg_thr=WET)
    base.update(kw)
    return TwoStageConfig(**base)


def _split(spark, sf_dir):
    c = _clean(spark, sf_dir)
    s = sp.train_test_split(c, qf.D_SPEC)
    return c, s.filter(F.col("role") == "train").drop("i", "n", "role"), s.filter(F.col("role") == "test").drop("i", "n", "role")


@query("fit_single_stage")
def q_fit_single_stage(spark, sf_dir):
    """ML5/ML6/PRJ5 — one GBT regressor on the training part, clipped
    predictions for the holdout."""
    c, tr, te = _split(spark, sf_dir)
    m = fit_single_stage(tr, _features(c), "precip_t1", SMALL)
    return present(m.transform(te).select("series", "fecha", "precip_t1", "y_hat"))


@query("fit_two_stage")
def q_fit_two_stage(spark, sf_dir):
    """ML7/ML8 — weighted classifier + wet-day regressor, hurdle predictions."""
    c, tr, te = _split(spark, sf_dir)
    m = fit_two_stage(tr, _cfg(c))
    return present(m.transform(te).select("series", "fecha", "precip_t1", "prob", "mm", "y_hat"))


def _folded(spark, sf_dir, k=sp.N_SPLITS):
    c = _clean(spark, sf_dir)
    return c, sp.assign_folds(c, qf.D_SPEC, n_splits=k, test_size=365, min_train_size=1095, strategy="sliding", short="drop")


@query("cv_single_stage")
def q_cv_single_stage(spark, sf_dir):
    """ML9/UDF3 — single-stage CV (5 sliding folds) with the average row."""
    c, f = _folded(spark, sf_dir)
    return present(run_cv(f, _features(c), "precip_t1", SMALL, threshold=WET))


@query("cv_two_stage")
def q_cv_two_stage(spark, sf_dir):
    """ML10 — two-stage CV: per fold tune the threshold on inner validation,
    refit, evaluate on the test part."""
    c, f = _folded(spark, sf_dir)
    return present(run_cv_two_stage(f, _cfg(c), peak=PEAK))


def _ledger(spark):
    """Fit ledger in the shared folder: a grid that was stopped goes on with
    the fits that are left when the query runs again over the same data."""
    return FitLedger(spark, f"{checkpoint_dir(spark)}/fit-ledger")


@query("clf_grid")
def q_clf_grid(spark, sf_dir):
    """ML11 — classifier grid (the 9 entries that MLlib can fit × 5 folds)
    summarised."""
    c, f = _folded(spark, sf_dir)
    return present(run_grid(f, _cfg(c), grids.CLASSIFIERS, stage="clf", parallelism=GRID_THREADS, ledger=_ledger(spark)))


@query("reg_grid")
def q_reg_grid(spark, sf_dir):
    """ML12 — regressor grid (the 6 entries that MLlib can fit × 5 folds)
    with the classifier fixed to the first of its grid."""
    c, f = _folded(spark, sf_dir)
    base = _cfg(c, clf_params=grids.CLASSIFIERS["clf_unbalance_base"])
    return present(run_grid(f, base, grids.REGRESSORS, stage="reg", parallelism=GRID_THREADS, ledger=_ledger(spark)))


@query("grid_resumed")
def q_grid_resumed(spark, sf_dir):
    """JOIN5/ML11 — the plan of two small configurations × 5 folds, stopped
    after four fits and taken up again: fits by configuration and fold."""
    c, f = _folded(spark, sf_dir)
    ledger = FitLedger(spark, scratch_path(spark, "fit-ledger"))
    entries = {"clf_few": {"n_estimators": 3, "max_depth": 3}, "clf_more": {"n_estimators": 5, "max_depth": 3}}
    try:
        run_grid(f, _cfg(c), entries, limit=4, parallelism=4, ledger=ledger)
    except GridUnfinished:
        run_grid(f, _cfg(c), entries, parallelism=4, ledger=ledger)
    fits = ledger.read()
    return present(fits.select("config", "fold", F.round(fits.metrics["auc"], 6).alias("auc"), fits.metrics["threshold"].alias("threshold")))


@query("two_stage_cross_validator")
def q_two_stage_cross_validator(spark, sf_dir):
    """ML5/ML7 — the two-stage estimator inside CrossValidator: RMSE by
    threshold over three folds."""
    c = _clean(spark, sf_dir)
    est = TwoStageEstimator.of(_cfg(c))
    rmse = RegressionEvaluator(labelCol="precip_t1", predictionCol="y_hat", metricName="rmse")
    grid = ParamGridBuilder().addGrid(est.threshold, [0.3, 0.5, 0.7]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=rmse, numFolds=3, seed=42, parallelism=3).fit(c)
    best = cv.bestModel.getOrDefault("threshold")
    return spark.createDataFrame([(m[est.threshold], float(r), m[est.threshold] == best) for m, r in zip(grid, cv.avgMetrics)],
                                 "threshold double, rmse double, chosen boolean")


@query("score_next_day")
def q_score_next_day(spark, sf_dir):
    """ML13/WIN6 — fit on all clean rows, score the last complete feature row
    of every series for the following day."""
    c = _clean(spark, sf_dir)
    m = fit_two_stage(c, _cfg(c))
    feats = qf._feature_table(spark, sf_dir).na.drop(subset=_features(c))
    last = latest_by_key(feats, ["series"], ["fecha"])
    out = m.transform(last)
    return present(out.select("series", F.date_add("fecha", 1).alias("prediction_date"), "prob", "mm",
                              (F.col("prob") > m.cfg.threshold).cast("int").alias("will_rain"),
                              F.lit("v1").alias("model_version")))


@query("retrain_compare")
def q_retrain_compare(spark, sf_dir):
    """ML14/ML15 — validate a retrained challenger on the last 90 rows of each
    series; promote only if its RMSE beats the current model's."""
    c = _clean(spark, sf_dir)
    return present(retrain_and_compare(c, ["series"], _cfg(c), current_rmse=60.0))


@query("save_load_model")
def q_save_load_model(spark, sf_dir):
    """SNK6/SNK7/SRC7 — publish a model with metadata, reload the live
    version and check its predictions equal the in-memory model's; the
    importance artifact is written as CSV."""
    c, tr, te = _split(spark, sf_dir)
    m = fit_two_stage(tr, _cfg(c))
    root = scratch_path(spark, "model-store")
    reg.publish(spark, root, m, tr, version="20260101_0000", clf_name="clf_small", reg_name="reg_small",
                baseline_metrics={"rmse": 60.0})
    reg.write_importance_csv(reg.importance_table(spark, m, top_n=10), f"{root}/importance")
    live = reg.load_live(spark, root)
    a = m.transform(te).select("series", "fecha", F.col("y_hat").alias("a"))
    b2 = live.transform(te).select("series", "fecha", F.col("y_hat").alias("b"))
    j = a.join(b2, ["series", "fecha"])
    return present(j.select("series", "fecha", "a", (F.abs(F.col("a") - F.col("b")) < 1e-12).alias("same")))


@query("daily_flow")
def q_daily_flow(spark, sf_dir):
    """§3.1 — daily job: tomorrow's two-stage scores for every series upserted
    into the predictions table, latest observations into actuals."""
    from pluvio.flows import daily_flow
    c = _clean(spark, sf_dir)
    m = fit_two_stage(c, _cfg(c))
    feats = qf._feature_table(spark, sf_dir)
    root = scratch_path(spark, "store")
    out = daily_flow(spark, feats, m, root, ["series"], "precip", version="v1", wet_threshold=WET)
    return present(out.select("series", "fecha", "prob_rain", "mm_predicted", "will_rain", "model_version"))


@query("daily_flow_tail")
def q_daily_flow_tail(spark, sf_dir):
    """ML13 — the daily job on the tail state: history up to 30 days before
    the end, then the days that follow in two runs of 15."""
    from pluvio.flows import daily_flow_from_tail
    c = _clean(spark, sf_dir)
    m = fit_two_stage(c, _cfg(c))
    raw = materialize(b.daily_lineitem(spark, sf_dir).withColumnsRenamed(qf.D_API_NAMES))
    end = raw.agg(F.max("fecha")).first()[0]
    at = lambda back: F.date_sub(F.lit(end), back)
    root, day = scratch_path(spark, "store"), F.col("fecha")
    tail = TailState(spark, f"{root}/tail", qf.D_SPEC, qf.D_CFG)
    tail.start(raw.where(day <= at(30)))
    for lo, hi in ((30, 15), (15, 0)):
        out = daily_flow_from_tail(spark, raw.where((day > at(lo)) & (day <= at(hi))), tail, m, root, "precip", version="v1", wet_threshold=WET)
    return present(out.select("series", "fecha", "prob_rain", "mm_predicted", "will_rain", "model_version"))


@query("monthly_flow")
def q_monthly_flow(spark, sf_dir):
    """§3.2 — monthly job over a stored history: trailing-30-day evaluation of
    every series, drift rule, retrain-and-compare for degraded series, log."""
    import datetime as dt

    from pluvio.flows import monthly_flow
    from pluvio.operators import store as st
    c = _clean(spark, sf_dir)
    m = fit_two_stage(c, _cfg(c))
    scored = m.transform(c).select(
        "series", "fecha", F.current_timestamp().alias("predicted_at"), F.col("prob").alias("prob_rain"),
        F.col("y_hat").alias("mm_predicted"), (F.col("prob") > m.cfg.threshold).cast("int").alias("will_rain"),
        F.lit("v1").alias("model_version"), F.lit(m.cfg.threshold).alias("threshold_used"))
    actual = c.select("series", "fecha", F.col("precip").alias("mm_actual"),
                      (F.col("precip") > WET).cast("int").alias("did_rain"), F.current_timestamp().alias("recorded_at"))
    root = scratch_path(spark, "store")
    st.upsert(spark, f"{root}/predictions", scored, ["series", "fecha"], ["predicted_at"])
    st.upsert(spark, f"{root}/actuals", actual, ["series", "fecha"], ["recorded_at"])
    ref = c.agg(F.max("fecha")).first()[0] + dt.timedelta(days=1)
    out = monthly_flow(spark, root, ["series"], ref, clean_features=c, cfg=_cfg(c), baseline_rmse=20.0,
                       recall_min=0.99, wet_threshold=WET)
    return present(out.select("id", "n_days", "rmse_current", "recall_current", "degraded", "retrained", "notes"))
