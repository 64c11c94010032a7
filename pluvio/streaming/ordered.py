"""Ordered state: a dry streak over rows that arrive out of order (STR4).

Rows of a series wait in state until the watermark has passed them; an
event-time timer then hands them out in time order, whatever the micro-batch
they came in. Rows that are late beyond the watermark are dropped by Spark, as
the rows behind them are already out. Any columns can be the key, NULL is a
key of its own; of rows that repeat a key and a time the last to arrive counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CONF = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """``transformWithState`` needs the RocksDB state store; the session's
    setting comes back afterwards."""
    before = spark.conf.get(_CONF)
    spark.conf.set(_CONF, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_CONF, before)


def run_lengths(values: np.ndarray, threshold: float, before: tuple[float, int] | None) -> np.ndarray:
    """Streak at each row of a time-ordered series: the number of rows right
    before it at or under ``threshold`` (NaN breaks). ``before`` carries the
    value and streak of the last row that is out; without it the first row
    begins at 0."""
    last = np.concatenate([[np.nan if before is None else before[0]], values[:-1]])
    dry = last <= threshold  # NaN compares false
    at = np.arange(1, len(values) + 1)
    reset = np.maximum.accumulate(np.where(dry, 0, at))
    return at - reset + np.where(reset == 0, before[1] if before else 0, 0)


def millis(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days * 86_400_000


class OrderedStreak(StatefulProcessor):
    """State of a series: the rows that wait, and (value, streak) of the last
    row that is out. One read and one write of each per call, not per row."""

    def __init__(self, keys: list[str], time: str, value: str, threshold: float, name: str):
        self.keys, self.time, self.value, self.threshold, self.name = keys, time, value, threshold, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("day", T.DateType()), T.StructField("value", T.DoubleType())]))
        self.last = handle.getValueState("last", T.StructType([T.StructField("value", T.DoubleType()), T.StructField("streak", T.IntegerType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(d, None if pd.isna(v) else float(v)) for b in rows for d, v in zip(b[self.time], b[self.value])]
        self.waiting.appendList(new)
        self.handle.registerTimer(millis(min(d for d, _ in new)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, rows = timerValues.getCurrentWatermarkInMs(), [tuple(r) for r in self.waiting.get()]
        ready = dict(sorted(((d, v) for d, v in rows if millis(d) <= passed), key=lambda r: r[0]))
        left = [r for r in rows if millis(r[0]) > passed]
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(millis(min(d for d, _ in left)))
        else:
            self.waiting.clear()
        if ready:
            before = self.last.get() if self.last.exists() else None
            if before is not None:
                before = (np.nan if before[0] is None else before[0], before[1])
            values = np.array([np.nan if v is None else v for v in ready.values()])
            streak = run_lengths(values, self.threshold, before)
            self.last.update((None if np.isnan(values[-1]) else float(values[-1]), int(streak[-1])))
            out = {k: [part] * len(ready) for k, part in zip(self.keys, key)}
            yield pd.DataFrame({**out, self.time: list(ready), self.name: streak.astype("int32")})

    def close(self) -> None:
        pass


def ordered_streak(daily: DataFrame, keys: list[str], threshold: float, time: str = "fecha", value: str = "precip",
                   name: str = "racha_seca", delay: str = "31 days") -> DataFrame:
    """(keys, time, streak) of a stream of (keys, time, value) rows that come
    in any order within ``delay``. Start the query inside ``state_store``."""
    rows = daily.select(*keys, F.col(time).cast("date").alias(time), F.col(value).cast("double").alias(value),
                        F.col(time).cast("date").cast("timestamp").alias("_at")).where(F.col(time).isNotNull())
    fields = [*[daily.schema[k] for k in keys], T.StructField(time, T.DateType()), T.StructField(name, T.IntegerType())]
    return rows.withWatermark("_at", delay).groupBy(*keys).transformWithStateInPandas(
        OrderedStreak(list(keys), time, value, threshold, name), T.StructType(fields), "Append", "EventTime")
