"""Tail state for daily features (ML13).

A feature row looks back over a bounded number of rows of its series; only the
dry streak may reach further. So the daily job needs the last rows of every
series and the streak at the first of them, not the history. Both are kept in
a table of generations: a run reads the newest complete one, computes the
features of the new rows on top of it, and writes the next. Generations that
are no longer read stay until ``prune`` is called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.operators.features import FeatureConfig, build_features, prepare
from pluvio.operators.splits import last_rows
from pluvio.operators.store import exists
from pluvio.series import SeriesSpec, join_null_safe
from pluvio.session import materialize

CARRY = "_streak_before"  # streak of the row, as the full history has it


def rows_back(cfg: FeatureConfig) -> int:
    """Rows before a row that its features read: the widest window, over a
    difference that itself looks back."""
    diffs = [n for named in cfg.diffs.values() for n in named.values()]
    return max([*(cfg.windows or (0,)), *cfg.lags, 1]) + max([*diffs, 0]) + 1


@dataclass
class TailState:
    """Last rows of every series under ``path``, a folder a generation."""
    spark: SparkSession
    path: str
    spec: SeriesSpec
    cfg: FeatureConfig

    def generations(self) -> list[int]:
        """Numbers of the complete generations (Spark marks them _SUCCESS)."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removeprefix("gen=")) for n in names if n.startswith("gen=") and exists(self.spark, f"{self.path}/{n}/_SUCCESS"))

    def read(self) -> DataFrame | None:
        gens = self.generations()
        return self.spark.read.parquet(f"{self.path}/gen={gens[-1]}") if gens else None

    def _write(self, rows: DataFrame) -> None:
        gens = self.generations()
        rows.write.mode("overwrite").parquet(f"{self.path}/gen={gens[-1] + 1 if gens else 0}")

    def start(self, history: DataFrame) -> None:
        """First generation from the whole history."""
        raw = prepare(history, self.spec, self.cfg.rename)
        self._write(self._tail(raw, build_features(history, self.spec, self.cfg)))

    def _tail(self, raw: DataFrame, features: DataFrame) -> DataFrame:
        """Last rows of ``raw`` (renamed input rows) with their streaks."""
        keys = [*self.spec.keys, self.spec.time]
        last = last_rows(raw.drop(CARRY), self.spec, rows_back(self.cfg), tail=True)
        streak = self.cfg.streak_name
        if streak not in features.columns:
            return last.withColumn(CARRY, F.lit(None).cast("int"))
        return join_null_safe(last, features.select(*keys, F.col(streak).alias(CARRY)), keys, "left")

    def advance(self, new: DataFrame) -> DataFrame:
        """Feature rows of the ``new`` rows (later than the tail's, one or
        more a series; series without a tail begin), equal to those over the
        whole history; then the next generation."""
        new = prepare(new, self.spec, self.cfg.rename)
        old = self.read()
        if old is None:
            old = new.limit(0).withColumn(CARRY, F.lit(None).cast("int"))
        mark = "_is_new"
        both = materialize(old.withColumn(mark, F.lit(False)).unionByName(new.withColumn(mark, F.lit(True)), allowMissingColumns=True))
        built = build_features(both, self.spec, self.cfg)
        streak = self.cfg.streak_name
        if streak in built.columns:
            order = Window.partitionBy(*self.spec.keys).orderBy(self.spec.time)
            # no wet row since the first one: the streak began before the tail
            open_ = F.col(streak) == F.row_number().over(order) - 1
            before = F.coalesce(F.first(CARRY).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
            built = built.withColumn(streak, (F.col(streak) + F.when(open_, before).otherwise(0)).cast("int"))
        built = materialize(built)
        self._write(self._tail(both.drop(mark), built))
        return built.where(mark).drop(mark, CARRY)

    def prune(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` complete generations."""
        old = self.generations()[:-keep]
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for g in old:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/gen={g}"), True)
        return old
