"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pluvio job expects. Timestamps are compared as UTC wall
# clock, AQE re-plans joins/partition counts from runtime statistics.
_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide feature plans (dozens of window aliases + NOT NULL filters) make
    # constraint inference explode combinatorially in the optimizer; the
    # inferred filters are not needed by any pluvio plan.
    "spark.sql.constraintPropagation.enabled": "false",
}


def tune_optimizer(spark: SparkSession) -> None:
    """Runtime-settable guards for sessions pluvio did not build itself."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def pin_utc(spark: SparkSession) -> None:
    """Streaming watermarks need TIMESTAMP; wall-clock (NTZ) times are read
    as UTC so day windows line up with calendar days."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def get_session(master: str | None = None, app: str = "pluvio",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with pluvio's defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A session on one
    machine (master ``local[...]``: tests, trials) may leave it unset and gets
    a temporary folder; anywhere else that folder would be seen by one machine
    only, so the missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pluvio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Compute ``df`` once and cut its lineage: a reliable ``checkpoint()``
    into the shared checkpoint folder (never ``localCheckpoint``). Used where
    a plan would otherwise reference an expensive input several times with
    different column sets (so exchange reuse cannot kick in)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
