"""Sharding by sampled splitters.

Records are ordered by a key (a hash of the text, so equal texts are
neighbours). A size-weighted sample of keys gives the quantile boundaries of
many ranges; exact range sizes are then summed over all records, overfull
ranges are subdivided, and whole ranges go to shards so that their bytes come
out nearly equal.

Null texts count as empty; ties in the key (equal texts) share a range unless
that range alone would overfill a shard; null ids and rows that repeat an id
and a text are rows of their own (every row has a number of its own, by which
such a range is split); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import stored


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, size, text_crc32, key); ``row`` is unique once stored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))


def splitters(rows: DataFrame, n_ranges: int, total: int, n_samples: int = 4096) -> list[int]:
    """Ascending key boundaries from a size-weighted sample: each record draws
    an exponential with rate ``size``, and those under 1.5 * n_samples / total
    win. ``total`` is the exact sum of the sizes, so about 1.5 * n_samples
    keys reach the driver, however many records and partitions there are. The
    draw is a hash of the row, so it is repeatable."""
    unit = (F.pmod(F.xxhash64(F.lit(17), "row", "key"), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    race = -F.log(unit) / F.col("size")
    keys = sorted(r[0] for r in rows.where(race < F.lit(1.5 * n_samples / max(total, 1))).select("key").collect())
    cuts = [keys[len(keys) * i // n_ranges] for i in range(1, n_ranges)] if keys else []
    return sorted(set(cuts))


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts that are <= key, as a balanced tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(cuts))


def assign(sizes: list[tuple[int, int, int]], n_shards: int) -> dict[tuple[int, int], int]:
    """Whole pieces (range, part, bytes) to shards, largest first onto the
    lightest shard. The list has one entry per range piece: bounded."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for rng, part, size in sorted(sizes, key=lambda x: (-x[2], x[0], x[1])):
        load, s = heapq.heappop(heap)
        out[(rng, part)] = s
        heapq.heappush(heap, (load + size, s))
    return out


def shard(docs: DataFrame, n_shards: int = 16, ranges_per_shard: int = 32, n_samples: int = 8192,
          rows_per_block: int = 5_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, key, shard, slot).

    A range above 1/8 of a shard's fair share is subdivided by a hash of the
    key, so equal texts stay together; a part that is still above a whole
    fair share (one hot text) is subdivided by a hash of the row. Slots
    are dense: rows are numbered inside (shard, block) and blocks are offset
    by a running sum over the small table of block counts; the number of
    blocks follows the number of rows."""
    rows = stored(measured(docs, id_col, text_col), "shard-rows")
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    cuts = splitters(rows, n_shards * ranges_per_shard, total, n_samples)
    d = rows.withColumn("range", range_of(F.col("key"), cuts))
    by_range = d.groupBy("range").agg(F.sum("size").alias("b")).collect()  # one row per range
    fair = max(1, -(-total // n_shards))

    def parts(found, limit):
        return {r: -(-4 * b // limit) for r, b in found if b > limit}

    def split(frame, name, of, counts, *by):
        n = F.lit(1)
        if counts:
            n = F.coalesce(F.element_at(F.create_map(*[x for kv in counts.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]), F.col(of)), F.lit(1))
        return frame.withColumn(name, F.pmod(F.xxhash64(F.lit(name), *by), n).cast("int"))

    d = split(d, "part", "range", parts([(r.range, r.b) for r in by_range], fair // 8 + 1), "key")
    d = d.withColumn("piece", F.col("range") * 4096 + F.col("part"))
    by_piece = d.groupBy("piece").agg(F.sum("size").alias("b")).collect()  # ranges and their few parts
    d = split(d, "sub", "piece", parts([(r.piece, r.b) for r in by_piece], fair), "key", "row")
    found = d.groupBy("piece", "sub").agg(F.sum("size").alias("b")).collect()
    place = assign([(r.piece, r["sub"], r.b) for r in found], n_shards)
    placed = d.sparkSession.createDataFrame([(p, s, t) for (p, s), t in place.items()] or [(0, 0, 0)],
                                            "piece int, sub int, shard int")  # as many rows as pieces: bounded
    d = d.join(F.broadcast(placed), ["piece", "sub"])
    n_blocks = max(1, n_rows // (n_shards * rows_per_block))
    d = d.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "row"), F.lit(n_blocks)).cast("int"))
    counts = d.groupBy("shard", "block").agg(F.count("*").alias("n"))
    first = counts.select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("first"))
    at = F.row_number().over(Window.partitionBy("shard", "block").orderBy("key", "doc_id", "row")) - 1
    return (d.withColumn("at", at).join(first, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", "key", "shard", (F.col("first") + F.col("at")).alias("slot")))
