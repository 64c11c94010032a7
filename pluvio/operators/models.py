"""Scoring-side column operators shared by the models (FN6-8, PRJ7-8, AGG17, ORD5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def magnitude(raw: Column, log_target: bool = True) -> Column:
    """FN6/FN7 — back-transform the regressor output (``expm1`` when trained
    on ``log1p``) and clip at 0 (NULL stays NULL)."""
    v = F.expm1(raw) if log_target else raw
    return F.when(v.isNull(), None).otherwise(F.greatest(v, F.lit(0.0)))


def hurdle(prob: Column, mm: Column, threshold: float | Column) -> Column:
    """FN8 — expected amount ``prob·mm`` when ``prob > threshold`` else 0."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(prob > thr, prob * mm).otherwise(F.lit(0.0))


def hurdle_combine(df: DataFrame, prob: str, raw: str, threshold, log_target: bool = True,
                   mm_col: str = "mm", out: str = "y_hat") -> DataFrame:
    """Two-stage combination of a classifier probability and a regressor output."""
    d = df.withColumn(mm_col, magnitude(F.col(raw), log_target))
    return d.withColumn(out, hurdle(F.col(prob), F.col(mm_col), threshold))


def align_features(df: DataFrame, feature_names: list[str], keep: list[str] = (),
                   fill: float = 0.0) -> DataFrame:
    """PRJ7/SET2 — the model's feature list in its order; features missing
    from ``df`` (set difference, decided at plan time) are added as ``fill``."""
    have = set(df.columns)
    cols = [F.col(c) if c in have else F.lit(fill).cast("double").alias(c) for c in feature_names]
    return df.select(*keep, *cols)


def missing_features(df: DataFrame, feature_names: list[str]) -> list[str]:
    """SET2 — expected features absent from ``df``."""
    have = set(df.columns)
    return [c for c in feature_names if c not in have]


def first_present(df: DataFrame, *candidates: str) -> Column:
    """PRJ8 — first candidate column that exists (plan-time fallback)."""
    for c in candidates:
        if c in df.columns:
            return F.col(c)
    raise ValueError(f"none of {candidates} present")


def importance_share(imp: DataFrame, top_n: int | None = None, feature: str = "feature",
                     importance: str = "importance") -> DataFrame:
    """AGG17/ORD5 — importance as % of all features (2 dp) and, for the
    ``top_n`` most important, as % of the top-n total. Totals are scalar
    subqueries (no cross join, no single-partition window). A model without a
    split has no importance at all: its shares are NULL."""
    total = imp.select(F.sum(importance)).scalar()
    out = imp.withColumn("importance_pct", F.round(F.try_divide(F.col(importance) * 100, total), 2))
    if top_n:
        top = imp.orderBy(F.col(importance).desc(), F.col(feature)).limit(top_n)
        top_total = top.select(F.sum(importance)).scalar()
        flag = top.select(feature, F.lit(True).alias("_top"))
        out = (out.join(flag, feature, "left")
               .withColumn("top_pct", F.when(F.col("_top"), F.try_divide(F.col(importance) * 100, top_total)))
               .drop("_top"))
    return out
