"""Queries: evaluation metrics, threshold search, CV/grid summaries, hurdle
combination and model comparison (AGG4-11, AGG17, JOIN4-5, JOIN7, FN6-8,
ORD4-5, SET1, SET3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.operators import metrics as mt
from pluvio.operators.models import hurdle_combine, importance_share
from pluvio.plans import bindings as b
from pluvio.plans.registry import present, query, rnd
from pluvio.series import join_null_safe

THR = 0.3  # classifier probability cut of the stand-in scores

S_SQL = """
SELECT o_orderkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 10000.0 ELSE 0.0 END AS y,
       floor(o_totalprice / 6000) / 100.0 AS prob,
       floor(o_totalprice / 6000) / 100.0 * (o_custkey % 50) AS y_pred
FROM orders"""

P_SQL = """
a AS (SELECT CAST(o_orderdate AS DATE) AS fecha, CAST(COUNT(*) AS DOUBLE) AS mm_actual FROM orders GROUP BY 1),
p AS (SELECT CAST(l_shipdate AS DATE) AS fecha, ROUND(LEAST(COUNT(*) / CAST(48 AS DOUBLE), 1.0), 4) AS prob_rain,
             ROUND(COUNT(*) / CAST(4 AS DOUBLE), 3) AS mm_predicted FROM lineitem GROUP BY 1),
pairs AS (SELECT a.fecha, a.mm_actual, p.mm_predicted, p.prob_rain FROM a JOIN p ON a.fecha = p.fecha)"""


def _pairs(spark, sf_dir):
    return b.actuals_by_day(spark, sf_dir).join(b.predictions_by_day(spark, sf_dir), "fecha", "inner")


def _raw(exprs):
    """Strip the output rounding from generated ``ROUND(...) AS name`` items."""
    out = []
    for x in exprs:
        body, name = x.rsplit(" AS ", 1)
        if body.startswith("ROUND(CAST("):
            inner = body[len("ROUND(CAST("):]
            inner = inner[:inner.index(" AS DOUBLE) + sign(")]
            body = inner
        out.append(f"{body} AS {name}")
    return out


def _reg_sql(y, p, cond="TRUE", suffix=""):
    e = f"CASE WHEN {cond} THEN {p} - {y} END"
    yy = f"CASE WHEN {cond} THEN {y} END"
    sse, sst = f"SUM(({e}) * ({e}))", f"VAR_POP({yy}) * COUNT({e})"
    return [f"{rnd(f'AVG(ABS({e}))')} AS mae{suffix}", f"{rnd(f'SQRT(AVG(({e}) * ({e})))')} AS rmse{suffix}",
            f"{rnd(f'CASE WHEN {sst} = 0 THEN CASE WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - {sse} / ({sst}) END')} AS r2{suffix}",
            f"{rnd(f'AVG(CASE WHEN {cond} AND {y} <> 0 THEN ABS(({y} - {p}) / {y}) END) * 100')} AS mape{suffix}"]


def _div0(num, den):
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END"


def _clf_sql(y, p, thr):
    tp = f"COUNT(*) FILTER (WHERE {y} > {thr} AND {p} > {thr})"
    fp = f"COUNT(*) FILTER (WHERE NOT ({y} > {thr}) AND {p} > {thr})"
    tn = f"COUNT(*) FILTER (WHERE NOT ({y} > {thr}) AND NOT ({p} > {thr}))"
    fn = f"COUNT(*) FILTER (WHERE {y} > {thr} AND NOT ({p} > {thr}))"
    prec, rec = _div0(tp, f"{tp} + {fp}"), _div0(tp, f"{tp} + {fn}")
    return [f"{rnd(_div0(f'{tp} + {tn}', f'{tp} + {fp} + {tn} + {fn}'))} AS accuracy",
            f"{rnd(prec)} AS precision", f"{rnd(rec)} AS recall",
            f"{rnd(_div0(f'2 * ({prec}) * ({rec})', f'({prec}) + ({rec})'))} AS f1_score",
            f"{tp} AS true_positives", f"{fp} AS false_positives", f"{tn} AS true_negatives",
            f"{fn} AS false_negatives"]


@query("regression_metrics", f"""
WITH {P_SQL}
SELECT CAST(year(fecha) AS INTEGER) AS yr, {', '.join(_reg_sql('mm_actual', 'mm_predicted'))}
FROM pairs GROUP BY 1""")
def q_regression_metrics(spark, sf_dir):
    """AGG4 — MAE/RMSE/R²/MAPE of forecast vs actual, per year."""
    p = _pairs(spark, sf_dir).withColumn("yr", F.year("fecha"))
    return present(p.groupBy("yr").agg(*mt.regression_aggs("mm_actual", "mm_predicted")))


@query("classification_metrics", f"""
WITH {P_SQL}
SELECT CAST(year(fecha) AS INTEGER) AS yr, {', '.join(_clf_sql('mm_actual', 'mm_predicted', b.P_WET_THRESHOLD))}
FROM pairs GROUP BY 1""")
def q_classification_metrics(spark, sf_dir):
    """AGG5 — wet/dry confusion counts, accuracy, precision, recall, F1, per year."""
    p = _pairs(spark, sf_dir).withColumn("yr", F.year("fecha"))
    return present(p.groupBy("yr").agg(*mt.classification_aggs("mm_actual", "mm_predicted", b.P_WET_THRESHOLD)))


@query("model_metrics", f"""
WITH s AS ({S_SQL})
SELECT o_orderpriority, {', '.join(_reg_sql('y', 'y_pred') + _clf_sql('y', 'y_pred', mt.CLASSIFICATION_THRESHOLD))}
FROM s GROUP BY 1""")
def q_model_metrics(spark, sf_dir):
    """AGG6 — regression ∪ classification metrics in one aggregation, per group."""
    return present(mt.evaluate(b.scored_orders(spark, sf_dir), "y", "y_pred", ["o_orderpriority"]))


def _auc_sql(group="o_orderpriority"):
    n = len(group.split(","))
    gb = ", ".join(str(i + 1) for i in range(n))
    return f"""
r AS (SELECT {group}, y > {mt.CLF_RAIN_THRESHOLD} AS pos,
             RANK() OVER (PARTITION BY {group} ORDER BY prob)
             + (COUNT(*) OVER (PARTITION BY {group}, prob) - 1) / 2.0 AS rk
      FROM s),
auc AS (SELECT {group},
          CASE WHEN COUNT(*) FILTER (WHERE pos) > 0 AND COUNT(*) FILTER (WHERE NOT pos) > 0 THEN
            (SUM(CASE WHEN pos THEN rk ELSE 0 END)
             - COUNT(*) FILTER (WHERE pos) * (COUNT(*) FILTER (WHERE pos) + 1) / 2.0)
            / (CAST(COUNT(*) FILTER (WHERE pos) AS DOUBLE) * COUNT(*) FILTER (WHERE NOT pos)) END AS auc
        FROM r GROUP BY {gb})"""


_AUC_SQL = _auc_sql()


@query("roc_auc", f"WITH s AS ({S_SQL}), {_AUC_SQL} SELECT o_orderpriority, {rnd('auc')} AS auc FROM auc")
def q_roc_auc(spark, sf_dir):
    """AGG8 — exact AUC per group via bucketed prefix counts (Mann-Whitney)."""
    s = b.scored_orders(spark, sf_dir)
    return present(mt.roc_auc(s, F.col("y") > mt.CLF_RAIN_THRESHOLD, "prob", ["o_orderpriority"]))


def _two_stage_sql(thr, group="o_orderpriority", src="s"):
    yb, pb = f"y > {mt.CLF_RAIN_THRESHOLD}", f"prob > {thr}"
    tp = f"COUNT(*) FILTER (WHERE {yb} AND {pb})"
    fp = f"COUNT(*) FILTER (WHERE NOT ({yb}) AND {pb})"
    fn = f"COUNT(*) FILTER (WHERE {yb} AND NOT ({pb}))"
    b2 = mt.F_BETA * mt.F_BETA
    wet = f"y > {mt.REG_RAIN_THRESHOLD}"
    n_wet = f"COUNT(*) FILTER (WHERE {wet})"
    peak = f"y > {mt.PEAK_THRESHOLD}"
    n_peak = f"COUNT(*) FILTER (WHERE {peak})"
    rain = _reg_sql("y", "y_pred", wet, "_rain")[:3]
    rain = [f"CASE WHEN {n_wet} > 1 THEN {x.rsplit(' AS ', 1)[0]} END AS {x.rsplit(' AS ', 1)[1]}" for x in rain]
    return [f"{rnd(_div0(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}'))} AS f1_clf",
            f"{rnd(_div0(f'{1 + b2} * {tp}', f'{1 + b2} * {tp} + {b2} * {fn} + {fp}'))} AS fbeta",
            f"{rnd(_div0(tp, f'{tp} + {fp}'))} AS precision", f"{rnd(_div0(tp, f'{tp} + {fn}'))} AS recall",
            *rain,
            f"{rnd(f'CASE WHEN {n_peak} > 0 THEN CAST(COUNT(*) FILTER (WHERE {peak} AND y_pred > {mt.REG_RAIN_THRESHOLD}) AS DOUBLE) / {n_peak} END')} AS recall_picos",
            *_reg_sql("y", "y_pred")[:3], f"CAST({thr} AS DOUBLE) AS threshold",
            f"{n_wet} AS n_lluvia", f"{n_peak} AS n_picos"]


@query("two_stage_metrics", f"""
WITH s AS ({S_SQL}), {_AUC_SQL},
m AS (SELECT o_orderpriority, {', '.join(_two_stage_sql(THR))} FROM s GROUP BY 1)
SELECT m.*, {rnd('auc.auc')} AS auc FROM m LEFT JOIN auc USING (o_orderpriority)""")
def q_two_stage_metrics(spark, sf_dir):
    """AGG7 — stage 1 (AUC, F1, F-beta, P, R), stage 2 on wet rows, peak
    recall and combined metrics, per group."""
    s = b.scored_orders(spark, sf_dir)
    return present(mt.two_stage_metrics(s, "y", "y_pred", "prob", THR, ["o_orderpriority"]))


def _best_thr_sql(group="o_orderpriority", src="s"):
    b2 = mt.F_BETA * mt.F_BETA
    yb = f"y > {mt.CLF_RAIN_THRESHOLD}"
    parts = []
    for i, t in enumerate(mt.CLF_THRESHOLDS):
        tp = f"COUNT(*) FILTER (WHERE {yb} AND prob > {t})"
        fp = f"COUNT(*) FILTER (WHERE NOT ({yb}) AND prob > {t})"
        fn = f"COUNT(*) FILTER (WHERE {yb} AND NOT (prob > {t}))"
        sc = _div0(f"{1 + b2} * {tp}", f"{1 + b2} * {tp} + {b2} * {fn} + {fp}")
        parts.append(f"SELECT {group}, {i} AS pos, CAST({t} AS DOUBLE) AS thr, {sc} AS score FROM {src} GROUP BY {group}")
    return (f"(SELECT {group}, thr AS best_threshold, score AS best_fbeta FROM ("
            f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY score DESC, pos) AS r FROM ("
            + " UNION ALL ".join(parts) + ") c) x WHERE r = 1)")


@query("best_threshold", f"WITH s AS ({S_SQL}) SELECT o_orderpriority, best_threshold, {rnd('best_fbeta')} AS best_fbeta FROM {_best_thr_sql()} t")
def q_best_threshold(spark, sf_dir):
    """AGG9/JOIN4 — threshold with the best F-beta (first of equals), per group."""
    s = b.scored_orders(spark, sf_dir)
    return present(mt.best_threshold(s, "y", "prob", ["o_orderpriority"]))


_CV_METRICS = ["mae", "rmse", "r2", "mape", "accuracy", "f1_score"]


@query("cv_summary", f"""
WITH s AS ({S_SQL}),
f AS (SELECT yr, {', '.join(_raw(_reg_sql('y', 'y_pred') + _clf_sql('y', 'y_pred', mt.CLASSIFICATION_THRESHOLD)))}
      FROM s GROUP BY 1)
SELECT CAST(yr AS VARCHAR) AS fold, {', '.join(f'{rnd(m)} AS {m}' for m in _CV_METRICS)} FROM f
UNION ALL
SELECT 'promedio', {', '.join(f'{rnd(f"AVG({m})")} AS {m}' for m in _CV_METRICS)} FROM f""")
def q_cv_summary(spark, sf_dir):
    """AGG10 — metrics per fold (fold = year) plus the average row."""
    s = b.scored_orders(spark, sf_dir).withColumnRenamed("yr", "fold")
    fm = mt.evaluate(s, "y", "y_pred", ["fold"])
    return present(mt.fold_summary(fm, _CV_METRICS))


def _grid_fold_metrics(s):
    """Per (config, fold): tune the threshold on that fold, evaluate stage 1 at it."""
    thr = mt.best_threshold(s, "y", "prob", ["config", "fold"])
    j = join_null_safe(s, thr, ["config", "fold"])
    yb = F.col("y") > mt.CLF_RAIN_THRESHOLD
    pb = F.col("prob") > F.col("best_threshold")
    c = mt.confusion(yb, pb)
    tp, fp, fn = c["tp"], c["fp"], c["fn"]
    m = j.groupBy("config", "fold").agg(
        F.first("best_threshold").alias("threshold"),
        mt._ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), mt.fbeta_from_counts(tp, fp, fn).alias("fbeta"),
        mt._ratio(tp, tp + fp).alias("precision"), mt._ratio(tp, tp + fn).alias("recall"))
    auc = mt.roc_auc(s, F.col("y") > mt.CLF_RAIN_THRESHOLD, "prob", ["config", "fold"])
    return join_null_safe(m, auc, ["config", "fold"], "left")


_GRID_M = ["auc", "f1", "fbeta", "precision", "recall"]
_GRID_STD = ["f1", "fbeta", "precision", "recall"]
URGENT = ("1-URGENT", "2-HIGH")


@query("grid_leaderboard", f"""
WITH s0 AS ({S_SQL}), s AS (SELECT *, o_orderpriority AS config, yr AS fold FROM s0),
{_auc_sql('config, fold')},
t AS {_best_thr_sql('config, fold')},
j AS (SELECT s.*, t.best_threshold FROM s JOIN t USING (config, fold)),
fm AS (SELECT config, fold, ANY_VALUE(best_threshold) AS threshold,
   {_div0('2 * COUNT(*) FILTER (WHERE y > 0.5 AND prob > best_threshold)', '2 * COUNT(*) FILTER (WHERE y > 0.5 AND prob > best_threshold) + COUNT(*) FILTER (WHERE NOT (y > 0.5) AND prob > best_threshold) + COUNT(*) FILTER (WHERE y > 0.5 AND NOT (prob > best_threshold))')} AS f1,
   {_div0(f'{1 + mt.F_BETA ** 2} * COUNT(*) FILTER (WHERE y > 0.5 AND prob > best_threshold)', f'{1 + mt.F_BETA ** 2} * COUNT(*) FILTER (WHERE y > 0.5 AND prob > best_threshold) + {mt.F_BETA ** 2} * COUNT(*) FILTER (WHERE y > 0.5 AND NOT (prob > best_threshold)) + COUNT(*) FILTER (WHERE NOT (y > 0.5) AND prob > best_threshold)')} AS fbeta,
   {_div0('COUNT(*) FILTER (WHERE y > 0.5 AND prob > best_threshold)', 'COUNT(*) FILTER (WHERE prob > best_threshold)')} AS precision,
   {_div0('COUNT(*) FILTER (WHERE y > 0.5 AND prob > best_threshold)', 'COUNT(*) FILTER (WHERE y > 0.5)')} AS recall
   FROM j GROUP BY 1, 2),
fa AS (SELECT fm.*, auc.auc FROM fm LEFT JOIN auc USING (config, fold)),
g AS (SELECT config, {', '.join(f'AVG({m}) AS avg_{m}' for m in _GRID_M)}, {', '.join(f'STDDEV_SAMP({m}) AS std_{m}' for m in _GRID_STD)},
             MIN(threshold) FILTER (WHERE c_thr = max_c) AS best_threshold
      FROM (SELECT *, MAX(c_thr) OVER (PARTITION BY config) AS max_c FROM
              (SELECT *, COUNT(*) OVER (PARTITION BY config, threshold) AS c_thr FROM fa) x) y
      GROUP BY 1)
SELECT config, CASE WHEN config IN {URGENT} THEN 'urgent' ELSE 'routine' END AS family,
       {', '.join(f'{rnd(f"avg_{m}")} AS avg_{m}' for m in _GRID_M)}, {', '.join(f'{rnd(f"std_{m}")} AS std_{m}' for m in _GRID_STD)},
       best_threshold, {rnd('avg_fbeta - std_fbeta')} AS robust_score,
       CAST(ROW_NUMBER() OVER (ORDER BY avg_fbeta - std_fbeta DESC NULLS LAST, config) AS INTEGER) AS rank
FROM g""")
def q_grid_leaderboard(spark, sf_dir):
    """AGG11/JOIN5/ORD4/SET1/SET3 — grid search summary: configurations
    (order priorities) × folds (years); per fold the threshold is tuned
    (AGG9) and stage-1 metrics taken at it; per configuration mean, sample
    std, modal threshold and robust score; the configuration list is split
    by a predicate into two families that are summarised and re-united."""
    s = (b.scored_orders(spark, sf_dir)
         .withColumn("config", F.col("o_orderpriority")).withColumn("fold", F.col("yr")))
    fm = _grid_fold_metrics(s)
    is_urgent = F.col("config").isin(*URGENT)
    fams = [(fm.filter(is_urgent), "urgent"), (fm.filter(~is_urgent), "routine")]
    parts = [mt.grid_summary(f, "config", _GRID_M, _GRID_STD).drop("rank")
             .withColumn("family", F.lit(name)) for f, name in fams]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True)
    from pyspark.sql import Window
    out = out.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("robust_score").desc_nulls_last(), F.col("config"))))
    return present(out)


@query("hurdle_combine", f"""
SELECT o_orderkey, o_orderpriority, {rnd('ln(1 + y_pred)')} AS raw,
       {rnd('GREATEST(exp(ln(1 + y_pred)) - 1, 0.0)')} AS mm,
       {rnd(f'CASE WHEN prob > {THR} THEN prob * GREATEST(exp(ln(1 + y_pred)) - 1, 0.0) ELSE 0.0 END')} AS y_hat
FROM ({S_SQL}) s""")
def q_hurdle_combine(spark, sf_dir):
    """FN6-8 — log-space magnitude back-transformed (``expm1``, clipped at 0)
    and combined with the probability: ``prob > thr ? prob·mm : 0``."""
    s = b.scored_orders(spark, sf_dir).withColumn("raw", F.log1p("y_pred"))
    return present(hurdle_combine(s, "prob", "raw", THR, log_target=True)
                   .select("o_orderkey", "o_orderpriority", "raw", "mm", "y_hat"))


@query("model_comparison", f"""
WITH s AS (SELECT *, CASE WHEN prob > {THR} THEN prob * GREATEST(exp(ln(1 + y_pred)) - 1, 0.0) ELSE 0.0 END AS y_hat
           FROM ({S_SQL}) s0),
b AS (UNPIVOT (SELECT {', '.join(x.rsplit(' AS ', 1)[0] + ' AS ' + x.rsplit(' AS ', 1)[1] for x in _reg_sql('y', 'y_pred'))} FROM s)
      ON mae, rmse, r2, mape INTO NAME metric VALUE baseline),
c AS (UNPIVOT (SELECT {', '.join(_reg_sql('y', 'y_hat'))} FROM s)
      ON mae, rmse, r2, mape INTO NAME metric VALUE candidate)
SELECT metric, baseline, candidate, {rnd('candidate - baseline')} AS delta,
       CASE WHEN candidate - baseline = 0 THEN 'equal'
            WHEN (metric IN ('mae', 'rmse', 'mape') AND candidate - baseline < 0)
              OR (metric NOT IN ('mae', 'rmse', 'mape') AND candidate - baseline > 0) THEN 'better'
            ELSE 'worse' END AS verdict
FROM b JOIN c USING (metric) WHERE baseline IS NOT NULL AND candidate IS NOT NULL""")
def q_model_comparison(spark, sf_dir):
    """JOIN7 — baseline (raw prediction) vs candidate (hurdle-combined)
    metrics, joined by metric name, with delta and verdict."""
    s = hurdle_combine(b.scored_orders(spark, sf_dir).withColumn("raw", F.log1p("y_pred")),
                       "prob", "raw", THR, log_target=True)
    base = present(s.agg(*mt.regression_aggs("y", "y_pred")))
    cand = present(s.agg(*mt.regression_aggs("y", "y_hat")))
    out = mt.compare_models(base, cand)
    return present(out.select("metric", "baseline", "candidate", "delta", "verdict"))


@query("feature_importance_share", f"""
WITH imp AS (SELECT p_type AS feature, SUM(p_retailprice) AS importance FROM part GROUP BY 1),
top AS (SELECT * FROM imp ORDER BY importance DESC, feature LIMIT 3)
SELECT i.feature, {rnd('i.importance')} AS importance,
       {rnd('ROUND(i.importance * 100 / (SELECT SUM(importance) FROM imp), 2)')} AS importance_pct,
       {rnd('CASE WHEN t.feature IS NOT NULL THEN i.importance * 100 / (SELECT SUM(importance) FROM top) END')} AS top_pct
FROM imp i LEFT JOIN top t ON i.feature = t.feature""")
def q_feature_importance_share(spark, sf_dir):
    """AGG17/ORD5 — importance share of all features (rounded 2 dp) and of
    the top-n only; summed part prices stand in for importances."""
    part = b.table(spark, sf_dir, "part")
    imp = part.groupBy(F.col("p_type").alias("feature")).agg(F.sum("p_retailprice").alias("importance"))
    return present(importance_share(imp, top_n=3))
