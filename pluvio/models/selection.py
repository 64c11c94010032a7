"""Model selection on temporal folds (ML9-ML15, SNK7).

Fold membership is a column (``assign_folds``); each fold's fit is a
distributed MLlib job. Fits are submitted from a small thread pool (as
``CrossValidator(parallelism=…)`` does) and all metrics are computed by one
grouped aggregation over the unioned predictions.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.models.fit_ledger import FitLedger, data_version, plan, work_off
from pluvio.models.task_trees import MOST_ROWS, TaskGBTClassifier, TaskGBTRegressor
from pluvio.models.two_stage import TwoStageConfig, TwoStageModel, assembled, balanced, fit_classifier, fit_single_stage, fit_two_stage
from pluvio.operators import metrics as mt
from pluvio.operators.splits import inner_validation
from pluvio.session import materialize, scratch_path


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


CV_METRICS = ["mae", "rmse", "r2", "mape", "accuracy", "precision", "recall", "f1_score",
              "true_positives", "false_positives", "true_negatives", "false_negatives"]


def run_cv(folded: DataFrame, features: list[str], label: str, params: dict | None = None,
           folds: list[int] | None = None, parallelism: int = 2, threshold: float = 1.0,
           fit: Callable = fit_single_stage, time: str = "fecha") -> DataFrame:
    """ML9/UDF3 — CV of any model: ``fit(train, features, label, params)``
    returns an object whose ``transform`` adds ``y_hat``. Per fold the
    metrics, sizes and periods, and the average row (AGG6 + AGG10)."""
    folds = folds or [r[0] for r in folded.select("fold").distinct().orderBy("fold").collect()]

    def one(f):
        tr = folded.filter((F.col("fold") == f) & (F.col("role") == "train"))
        te = folded.filter((F.col("fold") == f) & (F.col("role") == "test"))
        return fit(tr, features, label, params).transform(te)

    with ThreadPoolExecutor(parallelism) as ex:
        preds = _union(list(ex.map(one, folds)))
    fm = mt.evaluate(preds, label, "y_hat", ["fold"], threshold)
    train, test = F.col("role") == "train", F.col("role") == "test"
    extent = folded.groupBy(F.col("fold").cast("string").alias("fold")).agg(
        F.count_if(train).alias("train_size"), F.count_if(test).alias("test_size"),
        *[f(F.when(r, F.col(time))).alias(f"{n}_{e}") for n, r in (("train", train), ("test", test)) for e, f in (("start", F.min), ("end", F.max))])
    return mt.fold_summary(fm, CV_METRICS).join(extent, "fold", "left")


def _part(staged: DataFrame, fold, *roles: str) -> DataFrame:
    return staged.filter((F.col("fold") == fold) & F.col("role").isin(*roles))


def class_counts(staged: DataFrame, cfg: TwoStageConfig) -> dict:
    """(wet, dry) rows of every fold and role, counted once for all fits (AGG15)."""
    wet = F.col(cfg.label) > cfg.clf_thr
    return {(r["fold"], r["role"]): (r["p"], r["n"])
            for r in staged.groupBy("fold", "role").agg(F.count_if(wet).alias("p"), F.count_if(~wet).alias("n")).collect()}


def weighed(cfg: TwoStageConfig, counts: dict | None, fold, *roles: str) -> TwoStageConfig:
    """The configuration with the weight of the positives that the counts
    give, where the classes of these roles' rows decide it."""
    if counts is None or not balanced(cfg.clf_params or {}):
        return cfg
    p, n = (sum(counts.get((fold, r), (0, 0))[i] for r in roles) for i in (0, 1))
    return replace(cfg, clf_params={**(cfg.clf_params or {}), "scale_pos_weight": n / p if p else 1.0})


def tuned_classifier(staged: DataFrame, fold, cfg: TwoStageConfig, tune: bool = True, thresholds=mt.CLF_THRESHOLDS, counts: dict | None = None):
    """(threshold, classifier) of a fold: the threshold is tuned on the inner
    validation part (AGG9) with a classifier fitted on the rest, then the
    classifier is refitted on the full training part."""
    best = cfg.threshold
    if tune:
        inner = TwoStageModel(cfg, fit_classifier(_part(staged, fold, "fit"), weighed(cfg, counts, fold, "fit")), None)
        best = mt.best_threshold(inner.predict_proba(cfg.gathered(_part(staged, fold, "val"))), cfg.label, "prob", (), thresholds,
                                 cfg.clf_thr).first()["best_threshold"]
    return best, fit_classifier(_part(staged, fold, "fit", "val"), weighed(cfg, counts, fold, "fit", "val"))


def score_fold(staged: DataFrame, fold, cfg: TwoStageConfig, best: float, clf, regress: bool = True) -> DataFrame:
    """Predictions for a fold's test part with its own threshold."""
    at = replace(cfg, threshold=best)
    full = fit_two_stage(_part(staged, fold, "fit", "val"), at, clf=clf) if regress else TwoStageModel(at, clf, None)
    return full.transform(cfg.gathered(_part(staged, fold, "test"))).select("fold", cfg.label, "prob", "y_hat")


def run_cv_two_stage(folded: DataFrame, cfg: TwoStageConfig, folds: list[int] | None = None,
                     val_ratio: float = 0.2, thresholds=mt.CLF_THRESHOLDS, peak: float = mt.PEAK_THRESHOLD,
                     parallelism: int = 2, tune: bool = True, regress: bool = True) -> DataFrame:
    """ML10 — per fold: classifier threshold tuned on the inner validation
    part (AGG9), refit on the full training part, evaluation on the test part
    (AGG7). Without ``tune`` the configured threshold stays; without
    ``regress`` only the classifier is fitted."""
    staged = inner_validation(folded, val_ratio)
    folds = folds or [r[0] for r in staged.select("fold").distinct().orderBy("fold").collect()]

    def one(f):
        best, clf = tuned_classifier(staged, f, cfg, tune, thresholds)
        return best, materialize(score_fold(staged, f, cfg, best, clf, regress))

    with ThreadPoolExecutor(parallelism) as ex:
        done = list(ex.map(one, folds))
    # the threshold differs from fold to fold: each is evaluated at its own cut
    return _union([mt.two_stage_metrics(p, cfg.label, "y_hat", "prob", thr, ["fold"],
                                        clf_thr=cfg.clf_thr, reg_thr=cfg.reg_thr, peak=peak) for thr, p in done])


ROWS_PER_TASK = 50_000  # of a fold's training part; fewer, larger tasks for the many small jobs of boosting


def _few(sizes: dict) -> bool:
    return max(sizes.values(), default=0) <= MOST_ROWS


def stored_folds(folded: DataFrame, val_ratio: float, cfg: TwoStageConfig) -> tuple[DataFrame, dict]:
    """The folds written once, a folder for each fold and role, in as many
    files as their rows need; with the number of rows of each fold. Folds
    that are fitted in one task are written with their inputs as one vector,
    which keeps the plans of the many fits short."""
    staged = inner_validation(folded, val_ratio)
    sizes = {r["fold"]: r["n"] for r in staged.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = max(1, -(-max(sizes.values(), default=1) // ROWS_PER_TASK))
    piece = F.pmod(F.xxhash64(*[c for c in staged.columns if c not in ("fold", "role")]), F.lit(pieces))
    path = scratch_path(folded.sparkSession, "folds")
    dealt = staged.repartition(max(1, len(sizes) * pieces), "fold", piece)
    if _few(sizes):
        dealt = assembled(dealt, cfg.features, "fold", "role", cfg.label)
    dealt.write.partitionBy("fold", "role").parquet(path)
    return folded.sparkSession.read.parquet(path), sizes


@dataclass
class InTaskConfig(TwoStageConfig):
    """A configuration whose boosted trees grow in one task a fit; the few
    rows are also counted and scored in one, without a shuffle."""
    gbt_classifier = TaskGBTClassifier
    gbt_regressor = TaskGBTRegressor

    def gathered(self, df: DataFrame) -> DataFrame:
        return df.coalesce(1)


def grid_configs(base: TwoStageConfig, grid: dict[str, dict], stage: str) -> dict[str, TwoStageConfig]:
    """A configuration may set its own ``log_target``."""
    out = {}
    for name, params in grid.items():
        params = dict(params)
        cfg = replace(base, log_target=params.pop("log_target", base.log_target))
        out[name] = replace(cfg, clf_params=params) if stage == "clf" else replace(cfg, reg_params=params)
    return out


def run_grid(folded: DataFrame, base: TwoStageConfig, grid: dict[str, dict], stage: str = "clf",
             folds: list[int] | None = None, parallelism: int = 2, ledger: FitLedger | None = None,
             limit: int | None = None, val_ratio: float = 0.2, peak: float = mt.PEAK_THRESHOLD) -> DataFrame:
    """ML11/ML12/JOIN5 — the plan of configurations × folds, worked off
    through a fit ledger; then the grid summary (AGG11) over its rows. With
    the ``ledger`` of an earlier run only pairs that it lacks are fitted;
    ``limit`` bounds the fits of this call (``GridUnfinished`` if some are
    left). Folds of up to ``MOST_ROWS`` rows are fitted in one task each, larger
    ones by MLlib's jobs; the trees are the same. The classifier grid fits classifiers only. For the regressor grid
    the classifier and its threshold stay fixed (``base``), one per fold, and
    the least mean RMSE on wet rows ranks first."""
    spark = folded.sparkSession
    ledger = ledger or FitLedger(spark, scratch_path(spark, "fit-ledger"))
    staged, sizes = stored_folds(folded, val_ratio, base)
    few = _few(sizes)
    if few:
        base = InTaskConfig(**vars(base))
    folds = folds or sorted(sizes)
    counts = class_counts(staged, base)
    version = data_version(staged)
    configs = grid_configs(base, grid, stage)
    planned = plan(spark, stage, {n: asdict(c) | {"val_ratio": val_ratio, "peak": peak} for n, c in configs.items()}, folds, version)
    by_name, by_text = configs, {str(f): f for f in folds}
    fixed, locks = {}, {f: Lock() for f in folds}  # regressor grid: the classifier of a fold is fitted once

    def classifier(fold, cfg):
        if stage == "clf":
            return tuned_classifier(staged, fold, cfg, counts=counts)
        with locks[fold]:
            if fold not in fixed:
                fixed[fold] = tuned_classifier(staged, fold, cfg, tune=False, counts=counts)
            return fixed[fold]

    def fit(row: dict) -> dict:
        cfg, fold = by_name[row["config"]], by_text[row["fold"]]
        best, clf = classifier(fold, cfg)
        scored = materialize(score_fold(staged, fold, cfg, best, clf, regress=stage == "reg"))
        return mt.two_stage_metrics(scored, cfg.label, "y_hat", "prob", best, [], few, clf_thr=cfg.clf_thr, reg_thr=cfg.reg_thr,
                                    peak=peak).first().asDict()

    work_off(ledger, planned, fit, parallelism, limit)
    names = ["auc", "f1_clf", "fbeta", "precision", "recall", "threshold", "mae_rain", "rmse_rain", "r2_rain", "recall_picos", "mae", "rmse", "r2"]
    fm = ledger.results(planned).select("config", "fold", *[F.col("metrics")[m].alias("f1" if m == "f1_clf" else m) for m in names])
    if stage == "clf":
        return mt.grid_summary(fm, "config", ["auc", "f1", "fbeta", "precision", "recall"], ["f1", "fbeta", "precision", "recall"])
    return mt.grid_summary(fm, "config", ["mae_rain", "rmse_rain", "r2_rain", "recall_picos", "rmse", "r2"],
                           ["rmse_rain", "r2_rain"], threshold_col=None, rank_by="rmse_rain", ascending=True)


def retrain_and_compare(clean: DataFrame, spec_keys, cfg: TwoStageConfig, current_rmse: float,
                        holdout: int = 90) -> DataFrame:
    """ML14/ML15 — train a challenger without the last ``holdout`` rows of
    each series, validate it on them, and decide for it only when its RMSE
    beats the current one. Returns one decision row; ``retrain`` publishes."""
    from pluvio.operators.splits import last_rows
    from pluvio.series import SeriesSpec
    spec = SeriesSpec(keys=tuple(spec_keys), time="fecha")
    val = last_rows(clean, spec, holdout, tail=True)
    train = last_rows(clean, spec, holdout, tail=False)
    challenger = fit_two_stage(train, cfg)
    r = challenger.transform(val).agg(F.sqrt(F.avg(F.pow(F.col("y_hat") - F.col(cfg.label), 2))).alias("rmse_new"),
                                      F.count(F.lit(1)).alias("n_val"))
    return r.withColumns({"rmse_current": F.lit(float(current_rmse)),
                          "promote": F.col("rmse_new") < F.lit(float(current_rmse))})


def retrain(spark: SparkSession, root: str, clean: DataFrame, spec_keys, cfg: TwoStageConfig, current_rmse: float,
            version: str, holdout: int = 90) -> dict:
    """ML14/ML15/SNK7 — compare as ``retrain_and_compare``; if the challenger
    wins, refit on all rows and publish that model as ``version`` with its
    metadata. A rejected challenger leaves the store as it is."""
    from pluvio.models.registry import publish
    decision = retrain_and_compare(clean, spec_keys, cfg, current_rmse, holdout).first().asDict()
    if decision["promote"]:
        publish(spark, root, fit_two_stage(clean, cfg), clean, version, baseline_metrics={"rmse": decision["rmse_new"]})
    return decision | {"version": version if decision["promote"] else None}
