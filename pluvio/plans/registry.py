"""Registry of named queries (Spark side) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DP = 6  # doubles are rounded to this many places in query output (both sides)
# Engines sum in different orders, so an exact decimal tie (…5 at the 7th
# place) may come out a hair above in one engine and below in the other.
# Both sides nudge away from zero by NUDGE before rounding, so true ties
# round the same way everywhere.
NUDGE = 1e-9


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        # a module reload re-registers the same names: the latest definition wins
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def present(df: DataFrame, dp: int = DP) -> DataFrame:
    """Round every double column so engines that sum in another order agree.

    Built as one ``selectExpr`` (parsed JVM-side in a single call) — wide
    feature tables have hundreds of columns."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = f"CAST({q} AS DOUBLE)"
            exprs.append(f"ROUND({c} + SIGN({c}) * {NUDGE!r}, {dp}) AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)


def rnd(expr: str, dp: int = DP) -> str:
    """SQL twin of ``present`` for one expression."""
    return f"ROUND(CAST({expr} AS DOUBLE) + sign(CAST({expr} AS DOUBLE)) * {NUDGE}, {dp})"
