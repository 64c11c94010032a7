"""Evaluation metrics as grouped aggregates (AGG4-AGG11, JOIN4, JOIN7).

Every metric is a list of aggregate expressions, so it evaluates for any
grouping (series, fold, config, month…) in one pass with partial + final
aggregation. Ratios that would divide by zero follow the reference: 0 for
precision/recall/F-scores, NULL where the reference gives NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.ranks import weight_below
from pluvio.series import join_null_safe

# Fixed values of the reference.
F_BETA = 1.3                       # recall weighs more than precision
CLF_RAIN_THRESHOLD = 0.5           # "it rains" for the classifier label
REG_RAIN_THRESHOLD = 0.5           # wet rows for the regressor and peak hits
PEAK_THRESHOLD = 20.0              # peak days
CLASSIFICATION_THRESHOLD = 1.0     # default of the single-stage classification view
CLF_THRESHOLDS = [0.2, 0.3, 0.4, 0.5]


def _ratio(num: Column, den: Column) -> Column:
    """``num/den``, 0 when the denominator is 0 (zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def _r2(sse: Column, sst: Column) -> Column:
    # constant target: 1 if predictions are perfect, else 0
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)


def regression_aggs(y: str, p: str, mask: Column | None = None, suffix: str = "") -> list[Column]:
    """AGG4 — MAE, RMSE, R², MAPE (over non-zero actuals, ×100, NULL if none)."""
    m = mask if mask is not None else F.lit(True)
    yy, e = F.when(m, F.col(y)), F.when(m, F.col(p) - F.col(y))
    n = F.count(e)
    sse = F.sum(e * e)
    sst = F.var_pop(yy) * n
    ape = F.when(m & (F.col(y) != 0), F.abs((F.col(y) - F.col(p)) / F.col(y)))
    return [F.avg(F.abs(e)).alias(f"mae{suffix}"), F.sqrt(F.avg(e * e)).alias(f"rmse{suffix}"),
            _r2(sse, sst).alias(f"r2{suffix}"), (F.avg(ape) * 100).alias(f"mape{suffix}")]


def confusion(truth: Column, pred: Column) -> dict[str, Column]:
    return {"tp": F.count_if(truth & pred), "fp": F.count_if(~truth & pred),
            "tn": F.count_if(~truth & ~pred), "fn": F.count_if(truth & ~pred)}


def fbeta_from_counts(tp: Column, fp: Column, fn: Column, beta: float = F_BETA) -> Column:
    b2 = beta * beta
    return _ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)


def classification_aggs(y: str, p: str, threshold: float = CLASSIFICATION_THRESHOLD) -> list[Column]:
    """AGG5 — both series binarised at ``> threshold``; counts, accuracy,
    precision, recall, F1 (0 when undefined)."""
    c = confusion(F.col(y) > threshold, F.col(p) > threshold)
    tp, fp, tn, fn = c["tp"], c["fp"], c["tn"], c["fn"]
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return [_ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"), prec.alias("precision"),
            rec.alias("recall"), _ratio(2 * prec * rec, prec + rec).alias("f1_score"),
            tp.alias("true_positives"), fp.alias("false_positives"),
            tn.alias("true_negatives"), fn.alias("false_negatives")]


def evaluate(df: DataFrame, y: str, p: str, keys=(), threshold: float = CLASSIFICATION_THRESHOLD) -> DataFrame:
    """AGG6 — regression and classification metrics in one aggregation."""
    return df.groupBy(*keys).agg(*regression_aggs(y, p), *classification_aggs(y, p, threshold))


def roc_auc(df: DataFrame, label: Column, score: str, keys=(), few: bool = False) -> DataFrame:
    """AGG8 — exact ROC AUC per group, ties counted half (Mann-Whitney), NULL
    when a group has a single class.

    Plan: positives/negatives per distinct (group, score) — a partial
    aggregate; then the negatives below each score from ranges of the scores
    that sampled splitters make (``weight_below``), so scores that crowd
    together are split like any others. ``few`` rows are ranked in one task.
    """
    keys = list(keys)
    s = (df.select(*keys, F.col(score).alias("_s"), label.cast("int").alias("_y"))
         .filter(F.col("_s").isNotNull() & F.col("_y").isNotNull())
         .groupBy(*keys, "_s").agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg")))
    r = weight_below(s, keys, "_s", "_neg", "_below", few)
    tot_p, tot_n = F.sum("_pos"), F.sum("_neg")
    u = F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0))
    return r.groupBy(*keys).agg(
        F.when((tot_p > 0) & (tot_n > 0), u / (tot_p.cast("double") * tot_n)).alias("auc"))


def two_stage_aggs(y: str, y_pred: str, prob: str, threshold: float,
                   clf_thr: float = CLF_RAIN_THRESHOLD, reg_thr: float = REG_RAIN_THRESHOLD,
                   peak: float = PEAK_THRESHOLD, beta: float = F_BETA) -> list[Column]:
    """AGG7 (without AUC) — stage 1 on ``prob > threshold`` vs ``y > clf_thr``;
    stage 2 on wet rows (``y > reg_thr``, NULL unless more than one); peak
    recall (``y > peak`` hit when ``y_pred > reg_thr``); combined metrics."""
    c = confusion(F.col(y) > clf_thr, F.col(prob) > threshold)
    tp, fp, fn = c["tp"], c["fp"], c["fn"]
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    wet = F.col(y) > reg_thr
    n_wet = F.count_if(wet)
    rain = regression_aggs(y, y_pred, mask=wet, suffix="_rain")[:3]
    peaks = F.col(y) > peak
    n_peak = F.count_if(peaks)
    return [
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_clf"), fbeta_from_counts(tp, fp, fn, beta).alias("fbeta"),
        prec.alias("precision"), rec.alias("recall"),
        F.when(n_wet > 1, rain[0]).alias("mae_rain"), F.when(n_wet > 1, rain[1]).alias("rmse_rain"),
        F.when(n_wet > 1, rain[2]).alias("r2_rain"),
        F.when(n_peak > 0, F.count_if(peaks & (F.col(y_pred) > reg_thr)) / n_peak).alias("recall_picos"),
        *regression_aggs(y, y_pred)[:3],
        F.lit(float(threshold)).alias("threshold"), n_wet.alias("n_lluvia"), n_peak.alias("n_picos")]


def two_stage_metrics(df: DataFrame, y: str, y_pred: str, prob: str, threshold: float, keys=(),
                      few: bool = False, **kw) -> DataFrame:
    """AGG7 — all stage-1/stage-2/combined metrics plus exact AUC per group."""
    keys = list(keys)
    if not keys:  # one group: keyed by a constant, so both sides still meet by key
        one = df.withColumn("_one", F.lit(1))
        return two_stage_metrics(one, y, y_pred, prob, threshold, ["_one"], few, **kw).drop("_one")
    m = df.groupBy(*keys).agg(*two_stage_aggs(y, y_pred, prob, threshold, **kw))
    auc = roc_auc(df, F.col(y) > kw.get("clf_thr", CLF_RAIN_THRESHOLD), prob, keys, few)
    return join_null_safe(m, auc, keys, "left")


def best_threshold(df: DataFrame, y: str, prob: str, keys=(), thresholds=CLF_THRESHOLDS,
                   clf_thr: float = CLF_RAIN_THRESHOLD, beta: float = F_BETA) -> DataFrame:
    """AGG9/JOIN4 — arg-max F-beta over candidate thresholds, first wins.

    One pass: conditional counts for every candidate (no row × threshold
    product), then the minimum of ``(-score, position)`` picks the first best.
    """
    truth = F.col(y) > clf_thr
    aggs = []
    for i, t in enumerate(thresholds):
        pred = F.col(prob) > t
        aggs += [F.count_if(truth & pred).alias(f"_tp{i}"), F.count_if(~truth & pred).alias(f"_fp{i}"),
                 F.count_if(truth & ~pred).alias(f"_fn{i}")]
    g = df.groupBy(*keys).agg(*aggs)
    cands = F.array(*[F.struct((-fbeta_from_counts(F.col(f"_tp{i}"), F.col(f"_fp{i}"), F.col(f"_fn{i}"), beta))
                               .alias("neg"), F.lit(i).alias("pos"), F.lit(float(t)).alias("thr"))
                      for i, t in enumerate(thresholds)])
    best = F.array_min(cands)
    return g.select(*keys, best["thr"].alias("best_threshold"), (-best["neg"]).alias("best_fbeta"))


def fold_summary(fold_metrics: DataFrame, metrics: list[str], fold_col: str = "fold",
                 label: str = "promedio") -> DataFrame:
    """AGG10 — per-fold rows plus one average row (mean of the fold metrics,
    not pooled), fold label as string. ``rollup`` over the fold table."""
    r = fold_metrics.rollup(fold_col).agg(*[F.avg(m).alias(m) for m in metrics])
    return r.select(F.coalesce(F.col(fold_col).cast("string"), F.lit(label)).alias(fold_col), *metrics)


def grid_summary(fold_metrics: DataFrame, config_col: str, metrics: list[str],
                 std_metrics: list[str], threshold_col: str | None = "threshold",
                 rank_by: str = "fbeta", ascending: bool = False) -> DataFrame:
    """AGG11/ORD4 — per configuration: mean and sample std of fold metrics,
    the modal threshold (smallest on ties), robust score ``mean − std`` and a
    rank (score descending, name ascending breaks ties, NULLs last). With
    ``ascending`` (errors) the rank is by the mean itself, least first."""
    aggs = [F.avg(m).alias(f"avg_{m}") for m in metrics]
    aggs += [F.stddev_samp(m).alias(f"std_{m}") for m in std_metrics]
    if threshold_col:
        aggs.append(F.mode(threshold_col, deterministic=True).alias("best_threshold"))
    g = fold_metrics.groupBy(config_col).agg(*aggs)
    g = g.withColumn("robust_score", F.col(f"avg_{rank_by}") - F.col(f"std_{rank_by}"))
    # the leaderboard is one row per configuration (tens of rows): rank it
    by = F.col(f"avg_{rank_by}").asc_nulls_last() if ascending else F.col("robust_score").desc_nulls_last()
    w = Window.orderBy(by, F.col(config_col).asc())
    return g.withColumn("rank", F.row_number().over(w))


def compare_models(baseline: DataFrame, candidate: DataFrame, lower_is_better=("mae", "rmse", "mape")) -> DataFrame:
    """JOIN7 — unpivot two one-row metric tables, join on the metric name,
    delta and verdict; metrics missing or NULL on either side are skipped."""
    def long(df, name):
        cols = [c for c in df.columns]
        return df.select(*[F.col(c).cast("double") for c in cols]).unpivot([], cols, "metric", name)
    j = long(baseline, "baseline").join(long(candidate, "candidate"), "metric", "inner")
    j = j.filter(F.col("baseline").isNotNull() & F.col("candidate").isNotNull())
    delta = F.col("candidate") - F.col("baseline")
    lower = F.col("metric").isin(*lower_is_better)
    better = F.when(lower, delta < 0).otherwise(delta > 0)
    return j.withColumns({"delta": delta,
                          "verdict": F.when(delta == 0, "equal").when(better, "better").otherwise("worse")})
