"""Temporal splits on row positions (WIN8, ML1-ML4, JOIN3, AGG16).

Splits run on the *clean* rows of each series (after NULL removal), by dense
row position, with integer truncation — exactly one formula for every series
of any length, evaluated for all series at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.series import IDX, SeriesSpec, dense_index, join_null_safe

# Fixed defaults of the reference: 80/20 holdout, 5 folds of 365 test rows
# after at least 3×365 training rows.
TRAIN_SPLIT = 0.8
N_SPLITS = 5
TEST_SIZE = 365
MIN_TRAIN_SIZE = 365 * 3


def with_position(df: DataFrame, spec: SeriesSpec, name: str = "i") -> DataFrame:
    """WIN8 — 0-based dense position per series (bucketed, no global sort)
    plus the series length ``n`` (a per-series count joined back)."""
    from pluvio.session import materialize
    if not spec.keys:
        # one series: the range index is a checkpointed layout; its length is
        # a scalar subquery over that layout (the input is not read again)
        d = dense_index(df, spec, name=name)
        return d.withColumn("n", d.select(F.count(F.lit(1))).scalar())
    df = materialize(df)  # read by the index and by the length count: compute once
    d = dense_index(df, spec, name=name)
    return join_null_safe(d, series_lengths(df, spec), list(spec.keys))


def series_lengths(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows per series (partial + final aggregate: a hot key is pre-combined)."""
    return df.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("n"))


def train_test_split(df: DataFrame, spec: SeriesSpec, ratio: float = TRAIN_SPLIT) -> DataFrame:
    """ML1 — first ``int(n * ratio)`` clean rows of each series train, rest test."""
    d = with_position(df, spec)
    cut = F.floor(F.col("n") * F.lit(ratio))
    return d.withColumn("role", F.when(F.col("i") < cut, F.lit("train")).otherwise(F.lit("test")))


def _fold_cols(n, f, n_splits: int, test_size: int, min_train_size: int, strategy: str):
    """(train_lo, train_hi, test_hi) of 0-based fold ``f`` for a series of ``n`` rows.

    ``room = n - test - min_train``; offsets are ``f * (room div (k-1))``
    except the last fold, which is anchored at ``room`` (ends at ``n``)."""
    if strategy not in ("expanding", "sliding"):
        raise ValueError("strategy must be 'expanding' or 'sliding'")
    room = n - F.lit(test_size + min_train_size)
    step = F.floor(room / F.lit(n_splits - 1)) if n_splits > 1 else F.lit(0)
    off = F.when(f == n_splits - 1, room).otherwise(f * step)
    lo = F.lit(0) if strategy == "expanding" else off
    return room, lo.cast("long"), (off + min_train_size).cast("long"), (off + min_train_size + test_size).cast("long")


def short_series(lengths: DataFrame, keys: list[str] | tuple, test_size: int = TEST_SIZE,
                 min_train_size: int = MIN_TRAIN_SIZE) -> DataFrame:
    """Series that no fold can be cut from: (keys, n, needed)."""
    needed = F.lit(test_size + min_train_size).cast("long")
    return lengths.where(F.col("n") < needed).select(*keys, F.col("n").cast("long").alias("n"), needed.alias("needed"))


def _refuse_short(lengths: DataFrame, keys, test_size: int, min_train_size: int, short: str) -> None:
    if short not in ("raise", "drop"):
        raise ValueError("short must be 'raise' or 'drop'")
    if short == "raise":
        some = short_series(lengths, keys, test_size, min_train_size).limit(5).collect()
        if some:
            raise ValueError(f"series too short for one fold: {[tuple(r) for r in some]}; "
                             "pass short='drop' and report short_series()")


def fold_bounds(lengths: DataFrame, keys: list[str] | tuple, n_splits: int = N_SPLITS,
                test_size: int = TEST_SIZE, min_train_size: int = MIN_TRAIN_SIZE,
                strategy: str = "expanding", short: str = "raise") -> DataFrame:
    """ML2/ML3 — per series and fold: [train_lo, train_hi) and [train_hi, test_hi).
    Expanding trains from 0, sliding from the offset. A series too short for
    one fold is an error, or with ``short='drop'`` left to ``short_series``."""
    _refuse_short(lengths, keys, test_size, min_train_size, short)
    f = lengths.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("f"))
    room, lo, hi, te = _fold_cols(F.col("n"), F.col("f"), n_splits, test_size, min_train_size, strategy)
    return f.filter(room >= 0).select(*keys, (F.col("f") + 1).cast("int").alias("fold"),
                                      lo.alias("train_lo"), hi.alias("train_hi"), te.alias("test_hi"))


def assign_folds(df: DataFrame, spec: SeriesSpec, bounds: DataFrame | None = None,
                 n_splits: int = N_SPLITS, test_size: int = TEST_SIZE, min_train_size: int = MIN_TRAIN_SIZE,
                 strategy: str = "expanding", short: str = "raise") -> DataFrame:
    """JOIN3 — every row's (fold, role) for all folds at once.

    Each row already carries its position ``i`` and its series length ``n``,
    so its folds follow by arithmetic: the row is expanded to the ``k`` fold
    ids and kept where ``train_lo <= i < test_hi`` — no join, no shuffle.
    Given an explicit ``bounds`` table instead, it is range-joined on the
    series keys (equi-join + ``i`` in range). A series too short for one fold
    is an error, or with ``short='drop'`` left to ``short_series``."""
    d = with_position(df, spec)
    keys = list(spec.keys)
    if bounds is None:
        _refuse_short(series_lengths(df, spec), keys, test_size, min_train_size, short)
        x = d.withColumn("_f", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
        room, lo, hi, te = _fold_cols(F.col("n"), F.col("_f"), n_splits, test_size, min_train_size, strategy)
        j = (x.withColumns({"fold": (F.col("_f") + 1).cast("int"), "train_lo": lo, "train_hi": hi, "test_hi": te})
             .filter((room >= 0) & (F.col("i") >= F.col("train_lo")) & (F.col("i") < F.col("test_hi")))
             .drop("_f"))
    else:
        cond = (F.col("i") >= F.col("train_lo")) & (F.col("i") < F.col("test_hi"))
        b = bounds.withColumnsRenamed({k: f"_b_{k}" for k in keys})
        j = d.join(b, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys] + [cond], "inner").drop(*[f"_b_{k}" for k in keys])
    role = F.when(F.col("i") < F.col("train_hi"), F.lit("train")).otherwise(F.lit("test"))
    return j.withColumn("role", role)


def inner_validation(folded: DataFrame, val_ratio: float = 0.2) -> DataFrame:
    """ML4 — within each fold's training rows, the last ``val_ratio`` share is
    the validation part (``int(len * (1 - r))`` rows stay for fitting)."""
    train_len = F.col("train_hi") - F.col("train_lo")
    cut = F.col("train_lo") + F.floor(train_len * F.lit(1 - val_ratio))
    return folded.withColumn(
        "role", F.when(F.col("role") == "test", F.lit("test"))
                 .when(F.col("i") < cut, F.lit("fit")).otherwise(F.lit("val")))


def fold_extent(folded: DataFrame, keys: list[str] | tuple, time: str) -> DataFrame:
    """AGG16 — first/last date and size of every (series, fold, role) slice."""
    return folded.groupBy(*keys, "fold", "role").agg(
        F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("n"))


def last_rows(df: DataFrame, spec: SeriesSpec, n: int, tail: bool = True) -> DataFrame:
    """WIN7 — the last ``n`` rows of each series (``tail``) or all but them.

    Keyed series: one window, newest row first. For the tail Spark's window
    group limit keeps ``n`` rows per series and map task before the shuffle,
    so a hot series sends little. Without keys the dense index is used."""
    if spec.keys and not spec.chunked:
        w = Window.partitionBy(*spec.keys).orderBy(F.col(spec.time).desc())
        d = df.withColumn("_pos", F.row_number().over(w))
        return d.filter(F.col("_pos") <= n if tail else F.col("_pos") > n).drop("_pos")
    d = with_position(df, spec, name="_pos")
    keep = (F.col("_pos") >= F.col("n") - n) if tail else (F.col("_pos") < F.col("n") - n)
    return d.filter(keep).drop("_pos", "n")
