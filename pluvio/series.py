"""Series specification, NULL hygiene, dense row index and the window plans.

A *series* is the set of rows sharing the key columns, ordered by the time
column. All window features are row based (not calendar based): ``lag(x, 1)``
is the previous row of the same series, whatever its date.

Two physical plans are offered for window work:

``per-series``  ``Window.partitionBy(keys).orderBy(time)`` — one shuffle by
                key, one sort. Right when there are many series whose
                individual length is modest (a daily rollup has at most one
                row per calendar day per series).

``chunked``     the series is numbered densely (``dense_index``), cut into
                chunks of ``chunk_rows`` rows, and each chunk receives a
                *halo* copy of the last ``back`` rows of the previous chunk
                (and the first ``fwd`` rows of the next one). Windows then run
                ``partitionBy(keys, chunk).orderBy(index)`` so no task ever
                holds more than ``chunk_rows + back + fwd`` rows of a series,
                however long or skewed it is. Used automatically when a
                series has no key (a single global series would otherwise
                be pulled into one task).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDX = "_pv_i"      # dense 0-based row index inside a series
CHUNK = "_pv_c"    # chunk number (chunked plan)
HALO = "_pv_halo"  # true for halo copies (chunked plan)
BUCKET = "_pv_b"   # calendar bucket used to build the dense index


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns identify a series and which column orders it.

    ``chunk_rows``: ``None`` → per-series plan when keys exist, chunked plan
    (default 4096 rows) when there is no key; an int forces the chunked plan.
    """

    keys: tuple[str, ...] = ()
    time: str = "fecha"
    chunk_rows: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(self.keys))

    @property
    def chunked(self) -> bool:
        return self.chunk_rows is not None or not self.keys

    @property
    def chunk_size(self) -> int:
        return self.chunk_rows or 4096


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Spark keeps NaN distinct from NULL (and ``NaN > x`` is true); the
    operators treat missing values as NULL only, so convert once at sources."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in fl]
    if not targets:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in targets})


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL equals NULL (a series whose key is
    NULL is a series), keeping the left side's columns once. Still an
    equi-join: Spark hashes or sorts on the coalesced keys."""
    if not cols:
        raise ValueError("no join columns")
    r = right.withColumnsRenamed({c: f"_pv_j_{c}" for c in cols})
    on = [F.col(c).eqNullSafe(F.col(f"_pv_j_{c}")) for c in cols]
    return left.join(r, on, how).drop(*[f"_pv_j_{c}" for c in cols])


def _bucket(time_col: str) -> Column:
    """Deterministic calendar bucket (year*12 + month) — never sampled bounds."""
    t = F.col(time_col)
    return F.year(t) * 12 + F.month(t)


def dense_index(df: DataFrame, spec: SeriesSpec, name: str = IDX,
                order: list[str] | None = None) -> DataFrame:
    """0-based dense row number per series, computed without a global sort.

    Keyed series (a daily rollup: at most 31 rows per series and month):

    1. one window over (keys, calendar month): ``row_number`` and the month's
       row count — partitions are bounded by a calendar month of one series;
    2. from the first row of every month, a tiny (keys, month, count) table
       whose prefix sum per series gives each month's start offset;
    3. index = offset + row_number - 1 (the offsets join back by key).
    The input is referenced once, so its scan/shuffle is not repeated.

    The chunked plan (one series without keys, or ``chunk_rows`` set for long
    or hot series at any grain) numbers rows by ``range_index`` instead: no
    task ever holds more than one range partition.
    """
    keys = list(spec.keys)
    order_cols = order or [spec.time]
    if spec.chunked:
        return range_index(df, order_cols, name, keys)
    w_b = Window.partitionBy(*keys, BUCKET)
    numbered = (df.withColumn(BUCKET, _bucket(spec.time))
                .withColumn("_pv_rn", F.row_number().over(w_b.orderBy(*order_cols)))
                .withColumn("_pv_n", F.count(F.lit(1)).over(w_b)))
    w_off = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.filter(F.col("_pv_rn") == 1)
               .select(*keys, BUCKET, F.coalesce(F.sum("_pv_n").over(w_off), F.lit(0)).alias("_pv_off")))
    out = (join_null_safe(numbered, offsets, keys + [BUCKET])
           .withColumn(name, (F.col("_pv_off") + F.col("_pv_rn") - 1).cast("long"))
           .drop("_pv_off", "_pv_rn", "_pv_n", BUCKET))
    return out


PART = "_pv_p"  # range partition of a row (range_index)


def range_index(df: DataFrame, order_cols: list[str], name: str = IDX,
                keys: list[str] | tuple = ()) -> DataFrame:
    """0-based dense row number per series, skew-proof at any grain.

    1. ``repartitionByRange`` on (keys, order) — sampled bounds, so a series
       holding a third of all rows, or a busy stretch of time, is split over
       several partitions — sorted within each partition;
    2. ``monotonically_increasing_id`` numbers the rows of a partition in that
       order (partition id in its upper bits);
    3. per (series, partition): row count and first id; a running sum of the
       counts over the partitions of a series gives each piece's offset.
       Without keys that table has at most one row per shuffle partition and
       is broadcast (bound known before the job). With keys it has at most
       one row per series plus one per partition; AQE's size check decides
       between broadcast and a sort-merge join on (keys, partition), which
       also splits a hot series.

    Partition ids and row ids are frozen by a reliable ``checkpoint()``: the
    range bounds are sampled per shuffle, so the count branch and the row
    branch (and any recomputation after a lost executor) must read the same
    materialized layout.
    """
    from pluvio.session import materialize
    keys = list(keys)
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *keys, *order_cols)
                         .sortWithinPartitions(*keys, *order_cols)
                         .withColumn(PART, F.spark_partition_id().cast("long"))
                         .withColumn("_pv_r", F.monotonically_increasing_id()))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(*keys, PART)
               .agg(F.min("_pv_r").alias("_pv_first"), F.count(F.lit(1)).alias("_pv_n"))
               .select(*keys, PART, "_pv_first",
                       F.coalesce(F.sum("_pv_n").over(before), F.lit(0)).alias("_pv_off")))
    if not keys:
        offsets = F.broadcast(offsets)
    return (join_null_safe(ranged, offsets, keys + [PART])
            .withColumn(name, (F.col("_pv_off") + F.col("_pv_r") - F.col("_pv_first")).cast("long"))
            .drop(PART, "_pv_r", "_pv_first", "_pv_off"))


class SeriesWindow:
    """Prepares a frame for window expressions and undoes the preparation.

    Usage::

        sw = SeriesWindow(spec, back=30, fwd=1)
        d = sw.prepare(df)
        d = d.withColumns({... F.lag(x).over(sw.order) ...})
        d = sw.finish(d)
    """

    def __init__(self, spec: SeriesSpec, back: int = 0, fwd: int = 0):
        self.spec = spec
        self.back = back
        self.fwd = fwd
        self._order = None
        self._frames = {}
        if spec.chunked and spec.chunk_size < max(back, fwd, 1):
            raise ValueError(f"chunk_rows={spec.chunk_size} must be >= window reach {max(back, fwd)}")

    @property
    def partition_cols(self) -> list[str]:
        return list(self.spec.keys) + ([CHUNK] if self.spec.chunked else [])

    @property
    def order(self):
        # built once: every feature column reuses the same JVM window spec
        if self._order is None:
            o = IDX if self.spec.chunked else self.spec.time
            self._order = Window.partitionBy(*self.partition_cols).orderBy(o)
        return self._order

    def frame(self, lo, hi):
        if (lo, hi) not in self._frames:
            self._frames[(lo, hi)] = self.order.rowsBetween(lo, hi)
        return self._frames[(lo, hi)]

    def over_sql(self, lo: int | None = None, hi: int | None = None) -> str:
        """The same window as ``order`` / ``frame`` as SQL text, for building
        many window expressions with one JVM call each (``F.expr``)."""
        q = lambda c: "`" + c.replace("`", "``") + "`"
        o = IDX if self.spec.chunked else self.spec.time
        part = ", ".join(q(c) for c in self.partition_cols)
        spec = (f"PARTITION BY {part} " if part else "") + f"ORDER BY {q(o)}"
        if lo is not None:
            spec += f" ROWS BETWEEN {-lo} PRECEDING AND {-hi} PRECEDING"
        return f"OVER ({spec})"

    @property
    def position(self) -> Column:
        """Expression for the 0-based row position inside the series."""
        if self.spec.chunked:
            return F.col(IDX)
        return (F.row_number().over(self.order) - 1).cast("long")

    def prepare(self, df: DataFrame) -> DataFrame:
        if not self.spec.chunked:
            return df
        c = self.spec.chunk_size
        # the input is read by the index, the halo layout and the streak carry:
        # the range index is itself a checkpointed layout, computed once
        d = dense_index(df, self.spec)
        self.indexed = d  # one row per input row with its dense index (no halo copies)
        chunk = F.floor(F.col(IDX) / c).cast("long")
        pos = F.col(IDX) - chunk * c
        copies = [F.struct(chunk.alias("c"), F.lit(False).alias("h"))]
        if self.back:
            copies.append(F.when(pos >= c - self.back,
                                 F.struct((chunk + 1).alias("c"), F.lit(True).alias("h"))))
        if self.fwd:
            copies.append(F.when((pos < self.fwd) & (chunk > 0),
                                 F.struct((chunk - 1).alias("c"), F.lit(True).alias("h"))))
        arr = F.filter(F.array(*copies), lambda s: s.isNotNull())
        return (d.withColumn("_pv_cp", F.explode(arr))
                .withColumn(CHUNK, F.col("_pv_cp.c"))
                .withColumn(HALO, F.col("_pv_cp.h"))
                .drop("_pv_cp"))

    def finish(self, df: DataFrame, keep_index: bool = False) -> DataFrame:
        if not self.spec.chunked:
            return df
        out = df.filter(~F.col(HALO)).drop(HALO)
        return out if keep_index else out.drop(IDX, CHUNK)
