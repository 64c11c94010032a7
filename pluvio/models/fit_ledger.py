"""Resumable plan of fits (JOIN5, ML11, ML12).

A grid search is a table of (configuration, fold) pairs. Every pair has a key:
a hash of what the fit depends on (stage, fold, all parameters, the version of
the data). Finished fits are rows of a ledger table in the shared folder, so a
search that was stopped, or one with further configurations, fits only the
pairs that the ledger does not have yet. All pairs wait in one queue, whatever
their configuration; each worker thread submits its jobs in a scheduler pool of
its own, so that with ``spark.scheduler.mode=FAIR`` short fits are not held up
by long ones.
"""

from __future__ import annotations

import json
import time as clock
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.operators.store import exists

SCHEMA = ("key string, stage string, config string, fold string, params string, data_version string, "
          "metrics map<string,double>, seconds double, finished_at timestamp")


def data_version(df: DataFrame) -> str:
    """Fingerprint of a table's rows, whatever their order: their number and
    two sums of row hashes (one partial aggregate, one row back)."""
    cols = sorted(df.columns)
    h = lambda seed: F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)"))
    n, a, b = df.agg(F.count(F.lit(1)), h(1), h(2)).first()
    return f"{n}-{a or 0}-{b or 0}"


def plan(spark: SparkSession, stage: str, configs: dict[str, dict], folds: list, version: str) -> DataFrame:
    """(key, stage, config, fold, params, data_version): every configuration
    with every fold. The name of a configuration is no part of the key, so a
    renamed one is not fitted again."""
    rows = [(stage, name, json.dumps(p, sort_keys=True, default=str), version) for name, p in configs.items()]
    d = spark.createDataFrame(rows, "stage string, config string, params string, data_version string")
    d = d.withColumn("fold", F.explode(F.array(*[F.lit(str(f)) for f in folds])))
    return d.withColumn("key", F.sha2(F.concat_ws("\x1f", "stage", "fold", "params", "data_version").cast("binary"), 256))


@dataclass
class FitLedger:
    """Finished fits, one row in a folder of its own each, so that workers
    which end at the same time do not share a write job's temporary files.
    Two workers that finish the same key leave two rows; the first counts."""
    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        d = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.path)
        kept = [c for c in d.columns if c != "key"]
        return d.groupBy("key").agg(F.min_by(F.struct(*kept), "finished_at").alias("r")).select("key", "r.*")

    def record(self, row: dict, metrics: dict, seconds: float) -> None:
        numbers = {k: None if v is None else float(v) for k, v in metrics.items()}
        one = self.spark.createDataFrame([(row["key"], row["stage"], row["config"], row["fold"], row["params"], row["data_version"], numbers, seconds)],
                                         SCHEMA.rsplit(",", 1)[0])
        one.withColumn("finished_at", F.current_timestamp()).coalesce(1).write.parquet(f"{self.path}/{row['key'][:16]}-{uuid.uuid4().hex[:12]}")

    def missing(self, planned: DataFrame) -> list[dict]:
        """Pairs of the plan without a finished fit, each key once, in the
        plan's order of names and folds (as many rows as fits)."""
        left = planned.join(self.read().select("key"), "key", "left_anti").orderBy("config", "fold")
        return list({r["key"]: r.asDict() for r in left.collect()}.values())

    def results(self, planned: DataFrame) -> DataFrame:
        """Plan rows with ``metrics`` and ``seconds`` of their fits."""
        return planned.join(self.read().select("key", "metrics", "seconds"), "key")


class GridUnfinished(RuntimeError):
    """A search stopped at its limit; ``left`` fits wait in the plan."""

    def __init__(self, left: int):
        super().__init__(f"{left} fits are left; run the same search again to go on")
        self.left = left


def work_off(ledger: FitLedger, planned: DataFrame, fit: Callable[[dict], dict], parallelism: int = 2, limit: int | None = None) -> int:
    """Fit what is missing and record each fit as it ends; returns the number
    of fits made. With ``limit`` at most so many are made. An error stops the
    queue: fits that run are awaited and recorded, the others stay missing."""
    queue = ledger.missing(planned)
    todo = queue if limit is None else queue[:limit]
    sc = ledger.spark.sparkContext

    stop = Event()

    def one(i: int, row: dict) -> None:
        if stop.is_set():
            return
        sc.setLocalProperty("spark.scheduler.pool", f"fits-{i % parallelism}")
        began = clock.perf_counter()
        try:
            ledger.record(row, fit(row), clock.perf_counter() - began)
        except BaseException:
            stop.set()
            raise

    with ThreadPoolExecutor(parallelism) as ex:
        running = [ex.submit(one, i, row) for i, row in enumerate(todo)]
    for f in running:
        f.result()
    if len(todo) < len(queue):
        raise GridUnfinished(len(queue) - len(todo))
    return len(todo)
