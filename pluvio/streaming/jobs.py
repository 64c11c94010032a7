"""Structured Streaming versions of the daily jobs (STR1-STR4).

All jobs read a file stream, keep state in the checkpoint folder, and write
through ``foreachBatch`` with a keyed upsert, so replaying a micro-batch
after a failure leaves the target unchanged (exactly-once in effect).
``trigger(availableNow=True)`` processes everything present and stops.

Event-time watermarks need ``TIMESTAMP`` (not ``TIMESTAMP_NTZ``): the wall
clock times are read as UTC (the session time zone is pinned to UTC).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pluvio.operators import panes as pn
from pluvio.operators import store as st
from pluvio.session import materialize


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(directory)


def _run(query_builder, checkpoint: str) -> None:
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


PART = "_month"  # storage partition of streaming targets: calendar month of the date key


def upsert_sink(target: str, keys: list[str], order: list[str], partition_col: str | None = None):
    """foreachBatch sink: keyed upsert. The event columns ``order`` decide
    which version of a key wins, whenever it arrives; the batch id only
    decides between equal ones.
    With ``partition_col`` (a date column) the target is partitioned by its
    calendar month and each micro-batch rewrites only the months it touches,
    not the whole table. The batch is checkpointed first: the upsert reads it
    more than once, and a stateful query must not run twice for one batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("long"))
        part = None
        if partition_col:
            rows = rows.withColumn(PART, F.date_format(F.col(partition_col), "yyyy-MM"))
            part = PART
        rows = materialize(rows)
        if rows.isEmpty():  # an empty partitioned table has no file and so no schema
            return
        st.upsert(batch.sparkSession, target, rows, keys, order + ["_batch"], partition_col=part)
    return write


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """Read a streaming target without its bookkeeping columns."""
    d = spark.read.parquet(target)
    return d.drop(*[c for c in ("_batch", PART) if c in d.columns])


def daily_rollup_stream(events: DataFrame, aggregations: dict[str, list[str]], keys: list[str],
                        time: str = "ts", watermark: str = "2 days") -> DataFrame:
    """STR1 — incremental hourly → daily rollup with a watermark; rows later
    than the watermark are dropped (documented streaming semantics)."""
    from pluvio.operators.rollup import _agg
    t = F.col(time).cast("timestamp")
    ev = events.withColumn("_ts", t).withWatermark("_ts", watermark)
    exprs = [_agg(fn)(F.col(v)).alias(f"{v}_{fn}") for v, fns in aggregations.items() for fn in fns]
    g = ev.groupBy(*keys, F.window("_ts", "1 day").alias("w")).agg(*exprs)
    return g.select(*keys, F.to_date(F.col("w.start")).alias("fecha"), *[e for e in g.columns if e not in keys + ["w"]])


def run_daily_rollup(spark: SparkSession, source_dir: str, glob: str | None, schema: T.StructType,
                     aggregations: dict, keys: list[str], target: str, checkpoint: str,
                     time: str = "ts", max_files: int | None = None) -> DataFrame:
    s = daily_rollup_stream(file_stream(spark, source_dir, schema, glob, max_files), aggregations, keys, time)
    _run(s.writeStream.outputMode("update").foreachBatch(
        upsert_sink(target, keys + ["fecha"], [], partition_col="fecha")), checkpoint)
    return read_target(spark, target)


def run_upsert(spark: SparkSession, stream: DataFrame, keys: list[str], order: list[str],
               target: str, checkpoint: str, partition_col: str | None = None) -> DataFrame:
    """STR2 — streaming keyed upsert (newest row per key wins)."""
    _run(stream.writeStream.outputMode("append").foreachBatch(
        upsert_sink(target, keys, order, partition_col)), checkpoint)
    return read_target(spark, target)


def error_pane_stream(pairs: DataFrame, threshold: float, keys: list[str] | tuple = (), watermark: str = "31 days") -> DataFrame:
    """STR3 — forecast errors summed by day as they come; one state row and
    one output row for a series and day."""
    p = pairs.withColumn("_ts", F.col("fecha").cast("timestamp")).withWatermark("_ts", watermark)
    g = p.groupBy(*keys, F.window("_ts", "1 day").alias("w")).agg(*pn.error_sums(threshold))
    return g.select(*keys, F.to_date(F.col("w.start")).alias("day"), *pn.SUMS)


def sliding_errors(panes: DataFrame, days: int = 30, keys: list[str] | tuple = (), **guards) -> DataFrame:
    """STR3 — the panes of a stream's target merged into sliding windows of
    ``days`` days, one for each day, with the guards of AGG12."""
    s = pn.sliding(panes, pn.every_day(panes, days, keys), days, keys)
    s = s.withColumn("window_start", F.date_sub("end", days)).withColumnRenamed("end", "window_end")
    return pn.guarded(s, *keys, "window_start", "window_end", **guards).drop("n_wet")


STREAK_OUT = T.StructType([T.StructField("series", T.StringType()), T.StructField("fecha", T.DateType()),
                           T.StructField("racha_seca", T.IntegerType())])
STREAK_STATE = T.StructType([T.StructField("last_value", T.DoubleType()), T.StructField("streak", T.IntegerType()),
                             T.StructField("last_day", T.DateType())])


def streak_state_fn(threshold: float):
    """STR4 — per-series dry streak carried across micro-batches in state.

    Rows of one key arrive in time order batch after batch; within a batch
    they are sorted; rows not newer than the last processed day are late and
    dropped. State: (last value, streak at last row, last day)."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last_v, streak, last_day = (state.get if state.exists else (None, None, None))
        parts = [p for p in pdfs]
        rows = pd.concat(parts).sort_values("fecha") if parts else pd.DataFrame(columns=["fecha", "precip"])
        if last_day is not None:
            rows = rows[rows["fecha"] > last_day]
        out = []
        for day, v in zip(rows["fecha"], rows["precip"]):
            if streak is None:
                streak = 0
            else:
                streak = streak + 1 if (last_v is not None and not pd.isna(last_v) and last_v <= threshold) else 0
            out.append((key[0], day, int(streak)))
            last_v, last_day = (None if pd.isna(v) else float(v)), day
        if last_day is not None:
            state.update((last_v, streak, last_day))
        yield pd.DataFrame(out, columns=["series", "fecha", "racha_seca"])
    return fn


def streak_stream(daily: DataFrame, threshold: float) -> DataFrame:
    return daily.groupBy("series").applyInPandasWithState(
        streak_state_fn(threshold), STREAK_OUT, STREAK_STATE, "append", GroupStateTimeout.NoTimeout)


def ordered_file_drop(df: DataFrame, directory: str, part_col: str, keys: list[str] | tuple = ()) -> list:
    """Write a derived table as one file batch per value of ``part_col`` in
    ascending order, so a file stream sees them in time order. The table is
    computed once; each batch then reads its own partition. Rows of one key
    within one value go to a single file (``repartition(keys)``): files of
    one write job are not created in row order, so splitting a key's period
    over several files could hand its later rows to an earlier micro-batch."""
    spark, staged = df.sparkSession, directory.rstrip("/") + "-staged"
    df.write.mode("overwrite").partitionBy(part_col).parquet(staged)
    df = spark.read.parquet(staged)
    values = [r[0] for r in df.select(part_col).distinct().orderBy(part_col).collect()]
    for v in values:
        part = df.filter(F.col(part_col) == v).drop(part_col)
        part = part.repartition(*keys) if keys else part.coalesce(1)
        part.write.mode("append").parquet(directory)
    return values
