"""Operational tables on Parquet: predictions, actuals, evaluation log
(SNK1-SNK4, SRC5, AGG14, ORD2-3, ORD6, WIN6).

Parquet tables refuse ``MERGE``, so a keyed upsert ("insert or replace") is
``existing ∪ updates`` reduced to the newest row per key with a grouped
``max_by`` (partial + final aggregation, safe under a hot key), and only the
date partitions touched by the updates are rewritten (dynamic partition
overwrite). The merged result is checkpointed into the shared checkpoint
folder before the write, so the job never reads and overwrites the same files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.series import SeriesSpec, dense_index

PREDICTIONS = T.StructType([
    T.StructField("fecha", T.DateType(), False),
    T.StructField("predicted_at", T.TimestampType(), False),
    T.StructField("prob_rain", T.DoubleType(), False),
    T.StructField("mm_predicted", T.DoubleType(), False),
    T.StructField("will_rain", T.IntegerType(), False),
    T.StructField("model_version", T.StringType(), True),
    T.StructField("threshold_used", T.DoubleType(), True),
])
ACTUALS = T.StructType([
    T.StructField("fecha", T.DateType(), False),
    T.StructField("mm_actual", T.DoubleType(), False),
    T.StructField("did_rain", T.IntegerType(), False),
    T.StructField("recorded_at", T.TimestampType(), False),
])
RETRAINING_LOG = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("evaluated_at", T.TimestampType(), False),
    T.StructField("period_start", T.DateType(), False),
    T.StructField("period_end", T.DateType(), False),
    T.StructField("n_days", T.IntegerType(), False),
    T.StructField("rmse_current", T.DoubleType(), True),
    T.StructField("recall_current", T.DoubleType(), True),
    T.StructField("rmse_baseline", T.DoubleType(), True),
    T.StructField("recall_baseline", T.DoubleType(), True),
    T.StructField("degraded", T.IntegerType(), False),
    T.StructField("retrained", T.IntegerType(), False),
    T.StructField("new_model_version", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])
TABLES = {"predictions": PREDICTIONS, "actuals": ACTUALS, "retraining_log": RETRAINING_LOG}


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "overwrite", only_touched: bool = False) -> None:
    """SNK1 — full overwrite: what was there before is gone, the schema may
    change. With ``only_touched`` just the partitions that ``df`` has are
    replaced."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if only_touched else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def init_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """SNK2 — create the three operational tables if missing (idempotent)."""
    paths = {}
    for name, schema in TABLES.items():
        path = os.path.join(root, name)
        if not exists(spark, path):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key: ``max_by(row, (order...))`` as a grouped aggregate.
    Rows of a hot key are combined map-side before the shuffle. The buffer is
    a struct, so Spark aggregates over rows sorted by key."""
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]),
                                         F.struct(*[F.col(c) for c in order])).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def merge_latest(existing: DataFrame, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """SNK3 in DataFrame form: ``existing ∪ updates`` → newest row per key."""
    return latest_by_key(existing.unionByName(updates, allowMissingColumns=True), keys, order)


def prediction_rows(df: DataFrame, threshold_col: str = "threshold_used") -> DataFrame:
    """SNK3 row shaping for predictions: prob 4 dp, mm 3 dp, flag as int."""
    return df.select(
        "fecha", F.coalesce(F.col("predicted_at"), F.current_timestamp()).alias("predicted_at")
        if "predicted_at" in df.columns else F.current_timestamp().alias("predicted_at"),
        F.round("prob_rain", 4).alias("prob_rain"), F.round("mm_predicted", 3).alias("mm_predicted"),
        F.col("will_rain").cast("int").alias("will_rain"), "model_version",
        F.round(threshold_col, 3).alias("threshold_used"))


def actual_rows(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """SNK3 row shaping for actuals: mm 3 dp, ``did_rain = mm > threshold``."""
    return df.select("fecha", F.round("mm_actual", 3).alias("mm_actual"),
                     (F.col("mm_actual") > threshold).cast("int").alias("did_rain"),
                     (F.col("recorded_at") if "recorded_at" in df.columns
                      else F.current_timestamp()).alias("recorded_at"))


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], order: list[str],
           partition_col: str | None = None) -> DataFrame:
    """SNK3 — insert-or-replace by key into a Parquet table.

    Only partitions that receive updates are read, merged and rewritten.
    Replaying the same updates leaves the table unchanged (idempotent).
    """
    if not exists(spark, path):
        merged = latest_by_key(updates, keys, order)
        save_table(merged, path, [partition_col] if partition_col else None)
        return spark.read.parquet(path)
    existing = spark.read.parquet(path)
    if partition_col:
        touched = updates.select(partition_col).distinct()
        existing = existing.join(touched, partition_col, "left_semi")
    merged = merge_latest(existing, updates.select(*existing.columns), keys, order).checkpoint()
    save_table(merged, path, [partition_col] if partition_col else None, only_touched=bool(partition_col))
    return spark.read.parquet(path)


def with_sequence_ids(new_rows: DataFrame, start_after: DataFrame | None, order: str,
                      id_col: str = "id") -> DataFrame:
    """SNK4 id assignment: ``coalesce(max(id), 0) + dense position``; the
    position is built with the bucketed dense index (no global sort)."""
    base = (start_after.select(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
            if start_after is not None else F.lit(0).cast("long"))
    d = dense_index(new_rows, SeriesSpec(keys=(), time=order), name="_seq")
    return d.withColumn(id_col, base + F.col("_seq") + 1).drop("_seq")


def append_log(spark: SparkSession, path: str, rows: DataFrame, order: str = "evaluated_at",
               replay_keys: list[str] | None = None) -> None:
    """SNK4 — append evaluation rows with auto-increment ids, metrics 4 dp.

    Every row is kept, equal time stamps or not. Only if the caller names
    ``replay_keys`` (a run id and the series, say) are rows skipped whose keys
    are logged already, so that a repeated run adds nothing."""
    existing = spark.read.parquet(path) if exists(spark, path) else None
    if existing is not None and replay_keys:
        logged = existing.select(*[F.col(c).alias(f"_l_{c}") for c in replay_keys]).distinct()
        rows = rows.join(logged, [F.col(c).eqNullSafe(F.col(f"_l_{c}")) for c in replay_keys], "left_anti")
    out = with_sequence_ids(rows, existing, order)
    out = out.withColumns({c: F.round(c, 4) for c in
                           ["rmse_current", "recall_current", "rmse_baseline", "recall_baseline"]
                           if c in out.columns})
    if existing is not None:
        out = out.select(*existing.columns)
    out.write.mode("append").parquet(path)


def table_stats(tables: dict[str, DataFrame], date_col: dict[str, str]) -> DataFrame:
    """AGG14 — row count and latest date of each table, stacked."""
    parts = []
    for name, df in tables.items():
        dc = date_col.get(name)
        latest = F.max(dc).cast("string") if dc else F.lit(None).cast("string")
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), latest.alias("latest"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "latest"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recent(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """ORD2 — newest ``n`` rows (TakeOrderedAndProject: a top-k, no full sort)."""
    return df.orderBy(F.col(order_col).desc()).limit(n)
