"""Queries: experiment runs built from ``part`` (SNK5, SRC6, FN16-18, JOIN6,
ML16, PRJ11, SET4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.operators import runs as rn
from pluvio.plans import bindings as b
from pluvio.plans.registry import present, query, rnd
from pluvio.session import scratch_path


def runs_table(spark, sf_dir):
    """One run per part: stage from the part type, family = brand, config =
    part name; string params of several kinds; metrics from price and size."""
    p = b.table(spark, sf_dir, "part")
    stage = (F.when(F.col("p_type") == "ECONOMY", "clf_grid").when(F.col("p_type") == "SMALL", "reg_grid")
             .otherwise("two_stage_final"))
    mixed = (F.when(F.col("p_size") % 8 == 0, F.lit(None)).when(F.col("p_size") % 8 == 1, "False")
             .when(F.col("p_size") % 8 == 2, "True").when(F.col("p_size") % 8 == 3, F.col("p_size").cast("string"))
             .when(F.col("p_size") % 8 == 4, F.col("p_retailprice").cast("string"))
             .when(F.col("p_size") % 8 == 5, "1e3").when(F.col("p_size") % 8 == 6, " x ").otherwise(""))
    return p.select(
        F.concat(F.lit("run-"), F.col("p_partkey").cast("string")).alias("run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.col("p_name").alias("run_name"),
        F.create_map(F.lit("stage"), stage, F.lit("family"), F.col("p_brand"),
                     F.lit("config_name"), F.col("p_name")).alias("tags"),
        rn.to_param_map(("clf_size", F.col("p_size")), ("clf_mixed", mixed),
                        ("reg_price", F.col("p_retailprice")), ("threshold", F.lit("0.3")),
                        ("n_splits", F.lit(5))).alias("params"),
        rn.to_metric_map(("rmse", F.col("p_retailprice") / 100),
                         ("fbeta", F.when(F.col("p_size") % 5 != 0, F.col("p_size") / 50.0))).alias("metrics"))


_RUNS_SQL = """
runs AS (SELECT 'run-' || CAST(p_partkey AS VARCHAR) AS run_id, p_name AS run_name, p_brand AS family,
  CASE WHEN p_type = 'ECONOMY' THEN 'clf_grid' WHEN p_type = 'SMALL' THEN 'reg_grid' ELSE 'two_stage_final' END AS stage,
  p_size, p_retailprice,
  CASE p_size % 8 WHEN 0 THEN NULL WHEN 1 THEN 'False' WHEN 2 THEN 'True' WHEN 3 THEN CAST(p_size AS VARCHAR)
       WHEN 4 THEN CAST(p_retailprice AS VARCHAR) WHEN 5 THEN '1e3' WHEN 6 THEN ' x ' ELSE '' END AS mixed,
  p_retailprice / 100 AS rmse, CASE WHEN p_size % 5 <> 0 THEN p_size / 50.0 END AS fbeta
  FROM part)"""


@query("runs_search", f"WITH {_RUNS_SQL} SELECT run_id, run_name, family, {rnd('fbeta')} AS fbeta, {rnd('rmse')} AS rmse "
       "FROM runs WHERE stage = 'clf_grid'")
def q_runs_search(spark, sf_dir):
    """SRC6/SNK5 — classifier-grid runs ordered by F-beta (NULLs last)."""
    r = rn.search(runs_table(spark, sf_dir), {"stage": "clf_grid"}, "fbeta", ascending=False)
    return present(r.select("run_id", "run_name", F.col("tags")["family"].alias("family"),
                            F.col("metrics")["fbeta"].alias("fbeta"), F.col("metrics")["rmse"].alias("rmse")))


@query("params_typed", f"""WITH {_RUNS_SQL},
kv AS (SELECT run_id, 'clf_size' AS key, CAST(p_size AS VARCHAR) AS v FROM runs
       UNION ALL SELECT run_id, 'clf_mixed', mixed FROM runs WHERE mixed IS NOT NULL
       UNION ALL SELECT run_id, 'reg_price', CAST(p_retailprice AS VARCHAR) FROM runs
       UNION ALL SELECT run_id, 'threshold', '0.3' FROM runs
       UNION ALL SELECT run_id, 'n_splits', '5' FROM runs),
k AS (SELECT run_id, key, trim(v) AS t FROM kv),
c AS (SELECT *, CASE WHEN lower(t) IN ('true', 'false') THEN 'bool'
                     WHEN NOT contains(t, '.') AND regexp_full_match(t, '[+-]?[0-9]+') THEN 'int'
                     WHEN regexp_full_match(t, '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') THEN 'float'
                     ELSE 'string' END AS kind FROM k)
SELECT run_id, key, kind, CASE WHEN kind = 'bool' THEN lower(t) = 'true' END AS bool_value,
       CASE WHEN kind = 'int' THEN TRY_CAST(t AS BIGINT) END AS int_value,
       {rnd("CASE WHEN kind = 'float' THEN TRY_CAST(t AS DOUBLE) END")} AS float_value,
       CASE WHEN kind = 'string' THEN t END AS str_value
FROM c""")
def q_params_typed(spark, sf_dir):
    """FN16 — every stored param string typed: bool, int (no '.'), float, string."""
    return present(rn.typed_params(runs_table(spark, sf_dir)))


@query("params_prefix", f"""WITH {_RUNS_SQL}
SELECT run_id, CAST(p_size AS VARCHAR) AS params_size,
       CASE WHEN mixed IS NOT NULL THEN mixed END AS params_mixed,
       '0.3' AS params_threshold, 'none' AS params_objective, 'auto' AS params_class_weight
FROM runs WHERE stage = 'clf_grid'""")
def q_params_prefix(spark, sf_dir):
    """FN17/FN18/SET4/PRJ11 — classifier params: keys with prefix ``clf_``
    stripped, evaluation-only keys dropped, merged over defaults (right
    wins), flattened to ``params_*`` columns."""
    r = rn.search(runs_table(spark, sf_dir), {"stage": "clf_grid"})
    own = rn.strip_prefix(F.col("params"), "clf_")
    kept_eval = F.map_filter(F.col("params"), lambda k, v: k == "threshold")
    defaults = F.create_map(F.lit("objective"), F.lit("none"), F.lit("class_weight"), F.lit("auto"),
                            F.lit("size"), F.lit("0"))
    merged = rn.merge_maps(defaults, rn.merge_maps(rn.drop_keys(own), kept_eval))
    out = r.select("run_id", merged.alias("m"))
    return rn.flatten_params(out, "m", ["size", "mixed", "threshold", "objective", "class_weight"]).drop("m")


@query("best_run", f"""WITH {_RUNS_SQL}
SELECT family AS "group", run_id, run_name, {rnd('rmse')} AS rmse FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY rmse ASC NULLS LAST, run_name, run_id) AS r
  FROM runs WHERE stage = 'two_stage_final') x WHERE r = 1""")
def q_best_run(spark, sf_dir):
    """ML16/ORD4 — best final run per model family by RMSE (ties: name)."""
    r = rn.search(runs_table(spark, sf_dir), {"stage": "two_stage_final"})
    return present(rn.best_per_group(r, F.col("tags")["family"], "rmse"))


@query("winner_lookup", f"""WITH {_RUNS_SQL},
w AS (SELECT family, run_id, run_name FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY rmse ASC NULLS LAST, run_name, run_id) AS r
  FROM runs WHERE stage = 'two_stage_final') x WHERE r = 1)
SELECT w.family, w.run_id AS final_run_id, c.run_id AS clf_run_id, CAST(c.p_size AS BIGINT) AS clf_size
FROM w JOIN runs c ON c.stage = 'clf_grid' AND c.run_name = w.run_name""")
def q_winner_lookup(spark, sf_dir):
    """JOIN6 — winning final run per family → the classifier-grid runs of
    the same configuration → their (typed) parameters."""
    runs = runs_table(spark, sf_dir)
    winners = rn.best_per_group(rn.search(runs, {"stage": "two_stage_final"}), F.col("tags")["family"], "rmse")
    clf = rn.search(runs, {"stage": "clf_grid"}).select(
        F.col("run_id").alias("clf_run_id"), F.col("tags")["config_name"].alias("config"),
        rn.typed_param(F.col("params")["clf_size"])["int_value"].alias("clf_size"))
    j = winners.join(clf, winners["run_name"] == clf["config"], "inner")
    return j.select(F.col("group").alias("family"), F.col("run_id").alias("final_run_id"), "clf_run_id", "clf_size")


_CV_M = ["mae", "rmse", "r2", "mape", "accuracy", "f1_score"]


def _cv_runs_sql():
    from pluvio.plans import q_metrics as qm
    raw = qm._raw(qm._reg_sql("y", "y_pred") + qm._clf_sql("y", "y_pred", 1.0))
    keep = [x for x in raw if x.rsplit(" AS ", 1)[1] in _CV_M]
    return f"""
WITH s AS ({qm.S_SQL}),
f AS (SELECT yr, {', '.join(keep)} FROM s GROUP BY 1),
child AS (UNPIVOT (SELECT 'cv-' || CAST(yr AS VARCHAR) AS run_id, CAST('cv-parent' AS VARCHAR) AS parent_run_id,
                          {', '.join(_CV_M)} FROM f)
          ON {', '.join(_CV_M)} INTO NAME metric VALUE value),
parent AS (UNPIVOT (SELECT 'cv-parent' AS run_id, CAST(NULL AS VARCHAR) AS parent_run_id,
                           {', '.join(f'AVG({m}) AS cv_avg_{m}' for m in _CV_M)} FROM f)
           ON {', '.join(f'cv_avg_{m}' for m in _CV_M)} INTO NAME metric VALUE value)
SELECT run_id, parent_run_id, metric, {rnd('value')} AS value FROM child
UNION ALL SELECT run_id, parent_run_id, metric, {rnd('value')} AS value FROM parent"""


@query("runs_from_cv", _cv_runs_sql())
def q_runs_from_cv(spark, sf_dir):
    """SNK5/SRC6 — cross-validation (fold = year of the scored rows) logged
    as a parent run and one child run per fold, appended to a runs table in
    two writes and searched there by tag."""
    from pluvio.operators import metrics as mt
    fm = mt.evaluate(b.scored_orders(spark, sf_dir), "y", "y_pred", ["yr"])
    path = scratch_path(spark, "runs")
    rn.append_runs(rn.cv_runs(fm, "yr", _CV_M, "cv", {"stage": "cv"}, {"threshold": 1.0}), path)
    rn.append_runs(rn.cv_runs(fm.limit(0), "yr", _CV_M, "other", {"stage": "other"}), path)
    found = rn.search(rn.read_runs(spark, path), {"stage": "cv"})
    return present(found.select("run_id", "parent_run_id", F.explode("metrics").alias("metric", "value")))
