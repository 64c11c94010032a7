"""Queries: temporal splits on the clean feature rows (WIN7-8, ML1-4, JOIN3, AGG16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.operators import splits as sp
from pluvio.plans import bindings as b
from pluvio.plans import q_features as qf
from pluvio.plans import sqlgen as sg
from pluvio.plans.registry import query

SPEC = qf.D_SPEC
K, TEST, MIN_TRAIN = sp.N_SPLITS, sp.TEST_SIZE, sp.MIN_TRAIN_SIZE


def _clean(spark, sf_dir):
    return qf._feature_table(spark, sf_dir).na.drop("any").select("series", "fecha")


_CLEAN_SQL = f"""
clean AS (SELECT series, fecha FROM ({qf._feature_sql()}) t
          WHERE precip_lag1 IS NOT NULL AND precip_rmean_30 IS NOT NULL AND price_mean_rstd_30 IS NOT NULL
            AND precip_t1 IS NOT NULL),
pos AS (SELECT series, fecha, ROW_NUMBER() OVER (PARTITION BY series ORDER BY fecha) - 1 AS i,
               COUNT(*) OVER (PARTITION BY series) AS n FROM clean)"""


def _bounds_sql(strategy: str) -> str:
    room = f"(n - {TEST + MIN_TRAIN})"
    step = f"CAST(floor({room} / {float(K - 1)}) AS BIGINT)"
    off = f"CASE WHEN f = {K - 1} THEN {room} ELSE f * {step} END"
    lo = "0" if strategy == "expanding" else off
    return f"""
lengths AS (SELECT series, COUNT(*) AS n FROM clean GROUP BY 1),
bounds AS (SELECT series, CAST(f + 1 AS INTEGER) AS fold, CAST({lo} AS BIGINT) AS train_lo,
                  CAST({off} + {MIN_TRAIN} AS BIGINT) AS train_hi,
                  CAST({off} + {MIN_TRAIN + TEST} AS BIGINT) AS test_hi
           FROM lengths, range(0, {K}) r(f) WHERE {room} >= 0),
folded AS (SELECT p.series, p.fecha, p.i, p.n, b.fold, b.train_lo, b.train_hi, b.test_hi,
                  CASE WHEN p.i < b.train_hi THEN 'train' ELSE 'test' END AS role
           FROM pos p JOIN bounds b ON p.series = b.series AND p.i >= b.train_lo AND p.i < b.test_hi)"""


@query("train_test_split", f"""
WITH {_CLEAN_SQL}
SELECT series, fecha, i, n, CASE WHEN i < floor(n * CAST({sp.TRAIN_SPLIT} AS DOUBLE)) THEN 'train' ELSE 'test' END AS role
FROM pos""")
def q_train_test_split(spark, sf_dir):
    """ML1/WIN8 — first 80% of every series' clean rows train, rest test."""
    return sp.train_test_split(_clean(spark, sf_dir), SPEC).select("series", "fecha", "i", "n", "role")


def _folded(spark, sf_dir, strategy):
    return sp.assign_folds(_clean(spark, sf_dir), SPEC, n_splits=K, test_size=TEST,
                           min_train_size=MIN_TRAIN, strategy=strategy, short="drop")


@query("short_series", f"WITH {_CLEAN_SQL} SELECT series, n, CAST({TEST + MIN_TRAIN} AS BIGINT) AS needed "
       f"FROM (SELECT series, COUNT(*) AS n FROM clean GROUP BY 1) x WHERE n < {TEST + MIN_TRAIN}")
def q_short_series(spark, sf_dir):
    """ML2 — the series that the fold queries leave out, with their length
    and the length needed."""
    return sp.short_series(sp.series_lengths(_clean(spark, sf_dir), SPEC), ["series"], TEST, MIN_TRAIN)


_FOLD_COLS = ["series", "fecha", "i", "fold", "role", "train_lo", "train_hi", "test_hi"]


@query("cv_expanding", f"WITH {_CLEAN_SQL}, {_bounds_sql('expanding')} SELECT {', '.join(_FOLD_COLS)} FROM folded")
def q_cv_expanding(spark, sf_dir):
    """ML2/JOIN3 — expanding-window folds: (fold, role) of every clean row."""
    return _folded(spark, sf_dir, "expanding").select(*_FOLD_COLS)


@query("cv_sliding", f"WITH {_CLEAN_SQL}, {_bounds_sql('sliding')} SELECT {', '.join(_FOLD_COLS)} FROM folded")
def q_cv_sliding(spark, sf_dir):
    """ML3/JOIN3 — sliding-window folds (fixed training length)."""
    return _folded(spark, sf_dir, "sliding").select(*_FOLD_COLS)


@query("inner_validation", f"""
WITH {_CLEAN_SQL}, {_bounds_sql('sliding')}
SELECT series, fecha, fold,
       CASE WHEN role = 'test' THEN 'test'
            WHEN i < train_lo + floor((train_hi - train_lo) * CAST({1 - 0.2} AS DOUBLE)) THEN 'fit'
            ELSE 'val' END AS role
FROM folded""")
def q_inner_validation(spark, sf_dir):
    """ML4 — the last 20% of each fold's training rows validate (threshold
    tuning data), the rest fit."""
    return sp.inner_validation(_folded(spark, sf_dir, "sliding"), 0.2).select("series", "fecha", "fold", "role")


@query("fold_extent", f"""
WITH {_CLEAN_SQL}, {_bounds_sql('expanding')}
SELECT series, fold, role, MIN(fecha) AS start, MAX(fecha) AS "end", COUNT(*) AS n FROM folded GROUP BY 1, 2, 3""")
def q_fold_extent(spark, sf_dir):
    """AGG16 — first/last date and size of every (series, fold, role) slice."""
    return sp.fold_extent(_folded(spark, sf_dir, "expanding"), ["series"], "fecha")


@query("last_rows", f"""
SELECT series, fecha, precip FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY fecha DESC) AS r FROM ({sg.D_SQL}) d) x
WHERE r <= 90""")
def q_last_rows(spark, sf_dir):
    """WIN7 — the last 90 rows of every series (validation tail)."""
    d = b.daily_lineitem(spark, sf_dir)
    return sp.last_rows(d, SPEC, 90).select("series", "fecha", "precip")


@query("all_but_last_rows", f"""
SELECT series, fecha, precip FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY fecha DESC) AS r FROM ({sg.D_SQL}) d) x
WHERE r > 365""")
def q_all_but_last_rows(spark, sf_dir):
    """WIN7 — everything but the last 365 rows (pre-production training part)."""
    d = b.daily_lineitem(spark, sf_dir)
    return sp.last_rows(d, SPEC, 365, tail=False).select("series", "fecha", "precip")


@query("latest_complete_row", f"""
SELECT series, fecha, precip_lag1 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY fecha DESC) AS r
  FROM ({qf._feature_sql()}) t WHERE precip_rmean_30 IS NOT NULL AND price_mean_rstd_30 IS NOT NULL) x
WHERE r = 1""")
def q_latest_complete_row(spark, sf_dir):
    """WIN6 — last complete feature row per series (group ``max_by``, no sort)."""
    from pluvio.operators.store import latest_by_key
    f = qf._feature_table(spark, sf_dir).na.drop(subset=["precip_rmean_30", "price_mean_rstd_30"])
    return latest_by_key(f.select("series", "fecha", "precip_lag1"), ["series"], ["fecha"])
