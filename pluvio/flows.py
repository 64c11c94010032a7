"""The two production flows, composed from the operators.

``daily_flow``    last complete feature row of every series → two-stage
                  scores for the next day → keyed upsert into ``predictions``;
                  the latest observed value of every series → ``actuals``.
``monthly_flow``  trailing-period forecast ⟕ actual for every series → RMSE
                  and recall → drift rule → (only for degraded series) retrain
                  with a holdout comparison → one log row per series.

Both run for all series at once; the only driver-side values are the tiny
per-run decisions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.models.registry import version_now
from pluvio.models.selection import retrain
from pluvio.models.two_stage import TwoStageConfig, TwoStageModel
from pluvio.operators import monitor as mo
from pluvio.operators import store as st
from pluvio.operators.tail import TailState
from pluvio.session import materialize


def daily_flow(spark: SparkSession, features: DataFrame, model: TwoStageModel, root: str,
               keys: list[str], target_col: str, version: str, wet_threshold: float = 0.5) -> DataFrame:
    """ML13 + SNK3: score tomorrow for every series and store it (idempotent).
    The tables are partitioned by month, so a run rewrites the months it
    touches only."""
    complete = features.na.drop(subset=list(model.cfg.features))
    last = st.latest_by_key(complete, keys, ["fecha"])
    scored = model.transform(last)
    preds = scored.select(
        *keys, F.date_add("fecha", 1).alias("fecha"), F.current_timestamp().alias("predicted_at"),
        F.round("prob", 4).alias("prob_rain"), F.round("mm", 3).alias("mm_predicted"),
        (F.col("prob") > model.cfg.threshold).cast("int").alias("will_rain"),
        F.lit(version).alias("model_version"), F.round(F.lit(model.cfg.threshold), 3).alias("threshold_used"))
    observed = st.latest_by_key(features.filter(F.col(target_col).isNotNull()).select(*keys, "fecha", target_col),
                                keys, ["fecha"])
    actuals = observed.select(*keys, "fecha", F.round(target_col, 3).alias("mm_actual"),
                              (F.col(target_col) > wet_threshold).cast("int").alias("did_rain"),
                              F.current_timestamp().alias("recorded_at"))
    month = F.date_format("fecha", "yyyy-MM")
    st.upsert(spark, f"{root}/predictions", preds.withColumn("month", month), keys + ["fecha"], ["predicted_at"], "month")
    st.upsert(spark, f"{root}/actuals", actuals.withColumn("month", month), keys + ["fecha"], ["recorded_at"], "month")
    return spark.read.parquet(f"{root}/predictions").drop("month")


def daily_flow_from_tail(spark: SparkSession, new_rows: DataFrame, tail: TailState, model: TwoStageModel, root: str,
                         target_col: str, version: str, wet_threshold: float = 0.5) -> DataFrame:
    """ML13 — ``daily_flow`` for the new rows only: their features come from
    the tail state, not from the history. Series whose new rows are all
    incomplete keep the prediction that an earlier run stored."""
    features = tail.advance(new_rows)
    return daily_flow(spark, features, model, root, list(tail.spec.keys), target_col, version, wet_threshold)


def _months(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """A stored table; if it is partitioned by month, only the partitions
    that the period needs."""
    d = spark.read.parquet(path)
    if "month" not in d.columns:
        return d
    return d.where(F.col("month").between(F.lit(start.strftime("%Y-%m")), F.lit(end.strftime("%Y-%m"))))


def monthly_flow(spark: SparkSession, root: str, keys: list[str], reference_date: dt.date,
                 clean_features: DataFrame | None = None, cfg: TwoStageConfig | None = None,
                 baseline_rmse: float = mo.BASELINE_RMSE, pct: float = mo.RMSE_MAX_PCT_INCREASE,
                 recall_min: float = mo.RECALL_MIN, wet_threshold: float = mo.WET_THRESHOLD,
                 retrainer: Callable = retrain) -> DataFrame:
    """AGG12 + AGG18 (+ ML14/ML15 when degraded) + SNK4 for every series.

    The challenger is compared with the measured RMSE of the degraded series,
    pooled over their days. The log says per series what became of it:
    ``retrained`` and ``new_model_version`` are set only where a model was
    published; a series that is not degraded gets no retraining note; a
    retraining that fails is a note, not the end of the run."""
    start = reference_date - dt.timedelta(days=30)
    end = reference_date - dt.timedelta(days=1)
    pairs = mo.forecast_vs_actual(_months(spark, f"{root}/actuals", start, end), _months(spark, f"{root}/predictions", start, end),
                                  start, end, keys)
    perf = mo.recent_performance(pairs, keys, threshold=wet_threshold)
    perf = perf.withColumn("degraded", mo.degradation(F.col("rmse"), F.col("recall"), baseline_rmse, pct, recall_min))
    perf = materialize(perf)  # one row per series; read by the decision and by the log
    sums = perf.filter("degraded").agg(F.sum("n_days").alias("n"), F.sqrt(F.sum(F.col("rmse") ** 2 * F.col("n_days")) / F.sum("n_days")).alias("rmse")).first()
    version, note = None, "degraded; not retrained"
    if sums["n"] and clean_features is not None and cfg is not None:
        try:
            bad = perf.filter("degraded").select(*[F.col(k).alias(f"_b_{k}") for k in keys])
            rows = clean_features.join(bad, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys], "left_semi")
            decision = retrainer(spark, root, rows, keys, cfg, sums["rmse"], version_now())
            version = decision["version"]
            note = (f"challenger rmse={decision['rmse_new']:.3f} against {sums['rmse']:.3f}; "
                    + (f"published {version}" if version else "kept current"))
        except Exception as e:  # noqa: BLE001 — logged: the evaluation itself must not be lost
            note = f"retraining failed: {type(e).__name__}: {str(e)[:200]}"
    log_rows = perf.select(
        F.current_timestamp().cast("timestamp_ntz").alias("evaluated_at"),
        F.lit(start).alias("period_start"), F.lit(end).alias("period_end"), "n_days",
        F.col("rmse").alias("rmse_current"), F.col("recall").alias("recall_current"),
        F.lit(float(baseline_rmse)).alias("rmse_baseline"), F.lit(float(recall_min)).alias("recall_baseline"),
        F.col("degraded").cast("int").alias("degraded"),
        (F.col("degraded") & F.lit(version is not None)).cast("int").alias("retrained"),
        F.when(F.col("degraded"), F.lit(version)).alias("new_model_version"),
        F.concat_ws(" | ", *[F.col(k).cast("string") for k in keys],
                    F.when(F.col("degraded"), F.lit(note)).otherwise(F.lit("no degradation"))).alias("notes"))
    st.append_log(spark, f"{root}/retraining_log", log_rows)
    return spark.read.parquet(f"{root}/retraining_log")
