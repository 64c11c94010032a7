"""Versioned model store (SNK6, SNK7, SRC7).

A model is saved under ``<root>/models/<version>-<content>``, where content is
a hash of its configuration, its fitted parts and its training rows: two
publishes of one minute are two folders, and a folder that is live is never
written again. Its metadata row goes to ``<root>/model_metadata`` (Parquet,
nested types kept: arrays, maps, structs), and last of all a row of
``<root>/live`` points to it. A publish that stops before that leaves the old
model live; pointing back to an earlier row takes an earlier model live again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.models.fit_ledger import data_version
from pluvio.models.two_stage import TwoStageModel
from pluvio.operators.models import importance_share
from pluvio.operators.store import exists

METADATA = T.StructType([
    T.StructField("version", T.StringType(), False),
    T.StructField("content", T.StringType(), True),
    T.StructField("path", T.StringType(), False),
    T.StructField("trained_at", T.TimestampType(), True),
    T.StructField("train_start", T.DateType(), True),
    T.StructField("train_end", T.DateType(), True),
    T.StructField("n_samples", T.LongType(), True),
    T.StructField("n_features", T.IntegerType(), True),
    T.StructField("feature_names", T.ArrayType(T.StringType()), True),
    T.StructField("clf_name", T.StringType(), True),
    T.StructField("reg_name", T.StringType(), True),
    T.StructField("clf_params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("reg_params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("threshold", T.DoubleType(), True),
    T.StructField("log_target", T.BooleanType(), True),
    T.StructField("clf_rain_threshold", T.DoubleType(), True),
    T.StructField("reg_rain_threshold", T.DoubleType(), True),
    T.StructField("baseline_metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("degradation_thresholds", T.StructType([
        T.StructField("rmse_max_pct_increase", T.DoubleType()),
        T.StructField("recall_min", T.DoubleType())]), True),
])


def version_now() -> str:
    """FN14 — ``yyyyMMdd_HHmm`` (UTC)."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M")


POINTER = "version string, content string, pointed_at timestamp"


def content_of(model: TwoStageModel, train: DataFrame) -> str:
    """Hash of what makes a model: configuration, fitted parts, training rows."""
    parts = [getattr(s, "toDebugString", None) or f"{getattr(s, 'coefficients', '')} {getattr(s, 'intercept', '')}"
             for p in (model.clf, model.reg) if p is not None for s in p.stages]
    text = json.dumps([asdict(model.cfg), parts, data_version(train)], sort_keys=True, default=str)
    return hashlib.sha256(re.sub(r"uid=\w+", "", text).encode()).hexdigest()[:16]


def publish(spark: SparkSession, root: str, model: TwoStageModel, train: DataFrame,
            version: str, clf_name: str = "", reg_name: str = "",
            baseline_metrics: dict | None = None, time_col: str = "fecha") -> DataFrame:
    """SNK7 — save the model, append its metadata row, then point to it;
    returns that row. A model that is published already keeps its folder and
    is pointed to."""
    root, content = root.rstrip("/"), content_of(model, train)
    path = f"{root}/models/{version}-{content}"
    known = metadata(spark, root)
    meta = None if known is None else known.where((F.col("version") == version) & (F.col("content") == content)).limit(1)
    if meta is None or meta.isEmpty():
        model.save(path)  # without a metadata row it is a leftover of a stopped publish, which this one replaces
        ext = train.agg(F.min(time_col).alias("s"), F.max(time_col).alias("e"), F.count(F.lit(1)).alias("n")).first()
        cfg = model.cfg
        row = (version, content, path, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), ext["s"], ext["e"], int(ext["n"]),
               len(cfg.features), list(cfg.features), clf_name, reg_name,
               {k: str(v) for k, v in cfg.clf_params.items()}, {k: str(v) for k, v in cfg.reg_params.items()},
               float(cfg.threshold), bool(cfg.log_target), float(cfg.clf_thr), float(cfg.reg_thr),
               {k: float(v) for k, v in (baseline_metrics or {}).items()}, (0.20, 0.50))
        meta = spark.createDataFrame([row], METADATA)
        meta.write.mode("append").parquet(f"{root}/model_metadata")
    point_to(spark, root, version, content)
    return meta


def metadata(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root.rstrip('/')}/model_metadata"
    return spark.read.schema(METADATA).parquet(path) if exists(spark, path) else None


def point_to(spark: SparkSession, root: str, version: str, content: str) -> None:
    """Take a published model live: one pointer row in a folder of its own,
    so that the write is there whole or not at all."""
    found = metadata(spark, root)
    if found is None or found.where((F.col("version") == version) & (F.col("content") == content)).isEmpty():
        raise ValueError(f"no published model {version}-{content}")
    now = dt.datetime.now(dt.timezone.utc)
    row = spark.createDataFrame([(version, content)], "version string, content string").withColumn("pointed_at", F.current_timestamp())
    row.coalesce(1).write.parquet(f"{root.rstrip('/')}/live/{now:%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}")


def live_metadata(spark: SparkSession, root: str) -> DataFrame:
    """SRC7 — metadata of the model that the newest pointer names (grouped
    ``max_by``, no sort)."""
    live = spark.read.schema(POINTER).option("recursiveFileLookup", "true").parquet(f"{root.rstrip('/')}/live")
    newest = live.agg(F.max_by(F.struct("version", "content"), "pointed_at").alias("p")).select("p.*")
    return metadata(spark, root).join(F.broadcast(newest), ["version", "content"]).select(*METADATA.fieldNames()).dropDuplicates(["version", "content"])


def load_live(spark: SparkSession, root: str) -> TwoStageModel:
    path = live_metadata(spark, root).first()["path"]
    return TwoStageModel.load(spark, path)


def load_from_run(spark: SparkSession, runs: DataFrame, run_id: str) -> TwoStageModel:
    """ML16 — the model that a logged run points to (tag ``model_path``)."""
    row = runs.where(F.col("run_id") == run_id).select(F.col("tags")["model_path"].alias("p")).first()
    if row is None or row["p"] is None:
        raise ValueError(f"run {run_id!r} has no model_path tag")
    return TwoStageModel.load(spark, row["p"])


def importance_table(spark: SparkSession, model: TwoStageModel, top_n: int | None = None) -> DataFrame:
    """AGG17 — classifier feature importances as rows (one per feature, a
    vector of model width — tiny) with their shares."""
    imp = model.clf.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(model.cfg.features, [float(x) for x in imp])), "feature string, importance double")
    return importance_share(df, top_n)


def write_importance_csv(df: DataFrame, path: str, top: int = 30) -> None:
    """SNK6 — top features as a CSV artifact with header."""
    df.orderBy(F.col("importance").desc(), "feature").limit(top).coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(path)
