"""Exact ranks of values without a global sort in one task (AGG3, AGG8).

Distinct values are dealt to ranges by Spark's sampled splitters
(``repartitionByRange``), so the ranges follow the data however it is spread,
and the layout is frozen by a checkpoint. What stands below a range is the
running total over the ranges of its group, at most one row per group and
shuffle partition; inside a range a window counts on. A task holds one range,
never a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.series import join_null_safe
from pluvio.session import materialize

RANGE = "_range"


def ranged(distinct: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``distinct`` (keys, value, ...) with the number of its range; ranges
    of a group ascend."""
    return materialize(distinct.repartitionByRange(*keys, value).withColumn(RANGE, F.spark_partition_id()))


def carried(dealt: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """(keys, range, total, below): weight of a range and of those before it."""
    per = dealt.groupBy(*keys, RANGE).agg(F.sum(weight).alias("total"))
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("below", F.coalesce(F.sum("total").over(before), F.lit(0)))


def within(dealt: DataFrame, keys: list[str], value: str, weight: str, name: str) -> DataFrame:
    """Weight of the smaller values of the same range."""
    before = Window.partitionBy(*keys, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn(name, F.coalesce(F.sum(weight).over(before), F.lit(0)))


def weight_below(distinct: DataFrame, keys: list[str], value: str, weight: str, name: str, few: bool = False) -> DataFrame:
    """``distinct`` with the weight of all smaller values of its group. With
    ``few`` (a task's worth of rows, the caller knows) all are one range, in
    one partition, so nothing stands below it and nothing is shuffled."""
    if not keys:  # one group: keyed by a constant, so both sides still meet by key
        one = distinct.withColumn("_one", F.lit(1))
        return weight_below(one, ["_one"], value, weight, name, few).drop("_one")
    if few:
        return within(distinct.coalesce(1).withColumn(RANGE, F.lit(0)), keys, value, weight, name).drop(RANGE)
    dealt = ranged(distinct, keys, value)
    out = join_null_safe(within(dealt, keys, value, weight, "_here"), carried(dealt, keys, weight).drop("total"), [*keys, RANGE])
    return out.withColumn(name, F.col("below") + F.col("_here")).drop("below", "_here", RANGE)


def exact_quantiles(df: DataFrame, col: str, probs: list[float], keys: list[str] | tuple = ()) -> DataFrame:
    """(keys, q): array of the interpolated quantiles of each group, NULL
    values left out. Values are counted map-side; of the ranges only those
    that hold a rank in question are numbered through."""
    keys = list(keys)
    if not keys:
        return exact_quantiles(df.withColumn("_one", F.lit(1)), col, probs, ["_one"]).drop("_one")
    distinct = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    dealt = ranged(distinct, keys, "_v")
    parts = carried(dealt, keys, "_n")
    size = parts.groupBy(*keys).agg(F.sum("total").alias("size"))
    position = F.array(*[F.struct(F.lit(i).alias("at"), (F.lit(p) * (F.col("size") - 1)).alias("pos")) for i, p in enumerate(probs)])
    wanted = size.select(*keys, F.explode(position).alias("p")).select(*keys, "p.at", "p.pos")
    wanted = wanted.select(*keys, "at", "pos", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))).alias("rank"))
    held = join_null_safe(parts, wanted, keys).where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("total")))
    held = materialize(held.select(*keys, RANGE, "below", "at", "pos", "rank"))  # two rows per group and quantile at most
    few = join_null_safe(dealt, held.select(*keys, RANGE).distinct(), [*keys, RANGE])
    numbered = join_null_safe(within(few, keys, "_v", "_n", "_here"), held, [*keys, RANGE])
    start = F.col("below") + F.col("_here")
    found = numbered.where((start <= F.col("rank")) & (F.col("rank") < start + F.col("_n")))
    low, high = F.floor(F.first("pos")), F.ceil(F.first("pos"))
    a, b, pos = F.min("_v"), F.max("_v"), F.first("pos")
    one = found.groupBy(*keys, "at").agg(F.when(low == high, a).otherwise((high - pos) * a + (pos - low) * b).alias("v"))
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"])  # as many as quantiles
    return one.groupBy(*keys).agg(pairs.alias("q"))
