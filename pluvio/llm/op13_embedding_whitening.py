"""Embedding whitening over distinct vectors weighted by multiplicity.

Vectors are brought to whole numbers x = floor(64 * c) + 1000000. Equal x
vectors are grouped once; each distinct one enters the fit with its count (or
with one) as weight. Means are exact integer sums; the covariance is the sum
of weighted products of centred blocks, one partial matrix per task, summed
by Spark. Its eigenvectors (a dim x dim matrix on the driver) are sent back,
every distinct vector is projected once, and the rows join back.

Vectors that share one content are one row of the grouped table, whatever
their number. In the join back a vector with more than 1/512 of all rows
(there are at most 512) is sent to all tasks instead of being shuffled, so no
task gets all rows of a hot vector.

Rows whose vector is null, or holds a null or non-finite entry, are dropped,
and so are vectors of another length than the commonest (of equally common
ones the longest). Null ids stay rows; repeated rows are counted and
returned each; an empty table gives no rows; other columns are ignored.
Components without variance (eigenvalue under 1e-12 of the trace) cannot be
scaled: their ``whitened`` is null and they do not enter identity_error.
``deviation`` is null where it exceeds a long. Entries must be under 2^40.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import stored
from pluvio.llm.textvec import trim

SCALE, SHIFT = 64, 1_000_000  # fixed values
HOT_SHARE = 512  # a vector with more than 1/512 of the rows is hot


@dataclass(frozen=True)
class Whitening:
    components: int = 32
    weights: str = "count"  # or "one": each distinct vector counts once
    block: int = 4096  # vectors in one matrix product


@dataclass(frozen=True)
class Fit:
    """What leaves the cluster: one dim x dim matrix and its eigenvectors."""
    n: int
    sums: np.ndarray  # int64, exact
    trace: float
    eigenvalues: np.ndarray  # falling
    axes: np.ndarray  # dim x components


def whole(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that remain."""
    c = F.col(vec_col).cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(F.col(vec_col).isNotNull() & fine).select(
        F.col(id_col).alias("vec_id"), F.transform(c, lambda v: F.floor(v * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))


def distinct(rows: DataFrame, cfg: Whitening) -> DataFrame:
    """(key, x, n, w): each vector once, with its count and its weight."""
    d = rows.groupBy("key", "x").agg(F.count("*").alias("n"))
    return d.withColumn("w", F.col("n") if cfg.weights == "count" else F.lit(1).cast("long"))


def summed(parts: DataFrame, keys: list[str], kind: str) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("v").cast(kind).alias("v"))


def blocks(b: pd.DataFrame, column: str, dtype, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(values, weights) of at most ``size`` rows."""
    for lo in range(0, len(b), size):
        part = b.iloc[lo:lo + size]
        yield np.array(part[column].tolist(), dtype=dtype), part["w"].to_numpy()


def moments(table: DataFrame, column: str, centre, n: int, dim: int, cfg: Whitening) -> np.ndarray:
    """Covariance of ``column``: weighted products of centred blocks, one
    matrix per task, summed by Spark; divisor ``n``."""
    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            for x, w in blocks(b, column, np.float64 if column == "z" else np.int64, cfg.block):
                c = centre(x)
                total += (c * w[:, None]).T @ c
        i, j = np.triu_indices(dim)
        yield pd.DataFrame({"i": i, "j": j, "v": total[i, j]})
    parts = table.select(column, "w").mapInPandas(run, "i int, j int, v double")
    out = np.zeros((dim, dim))
    for r in summed(parts, ["i", "j"], "double").collect():  # dim x dim numbers
        out[r.i, r.j] = out[r.j, r.i] = r.v / n
    return out


def means(table: DataFrame, column: str, dim: int, cfg: Whitening) -> np.ndarray:
    """Weighted sums by dimension, exact for whole numbers."""
    dtype, kind = (np.float64, "double") if column == "z" else (np.int64, "bigint")

    def run(batches):
        total = np.zeros(dim, dtype=dtype)
        for b in batches:
            for x, w in blocks(b, column, dtype, cfg.block):
                total += (x * w[:, None]).sum(axis=0)
        yield pd.DataFrame({"i": np.arange(dim), "v": total})
    parts = table.select(column, "w").mapInPandas(run, f"i int, v {kind}")
    out = np.zeros(dim, dtype=dtype)
    for r in summed(parts, ["i"], kind).collect():
        out[r.i] = r.v
    return out


def fit(table: DataFrame, dim: int, cfg: Whitening) -> Fit:
    """Eigenvectors of the covariance over the fit list. Centring subtracts
    exact integers, (n * x - S) / n, so nothing is lost to the large shift."""
    n = table.agg(F.sum("w")).first()[0]
    sums = means(table, "x", dim, cfg)
    v = moments(table, "x", lambda x: (n * x - sums) / n, n, dim, cfg)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(cfg.components, dim)
    return Fit(n, sums, float(np.trace(v)), e[:k], axes[:, :k])


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, in whole numbers."""
    d = n * x - sums
    most = int(np.abs(d).max(initial=0))
    if most * most * max(d.shape[1], 1) < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in exact]


def projected(table: DataFrame, f: Fit, cfg: Whitening) -> DataFrame:
    """(key, n, w, deviation, z) of every distinct vector; components without
    variance are left out of z (they are the last ones)."""
    shared = table.sparkSession.sparkContext.broadcast(f)
    schema = "key binary, n long, w long, deviation long, z array<double>"

    def run(batches):
        fit = shared.value
        scale = fit.axes[:, :usable(fit)] / np.sqrt(fit.eigenvalues[:usable(fit)])
        for b in batches:
            for lo in range(0, len(b), cfg.block):
                part = b.iloc[lo:lo + cfg.block]
                x = np.array(part["x"].tolist(), dtype=np.int64)
                z = ((fit.n * x - fit.sums) / fit.n) @ scale
                yield pd.DataFrame({"key": part["key"], "n": part["n"], "w": part["w"],
                                    "deviation": pd.array(deviations(x, fit.n, fit.sums), dtype="Int64"), "z": list(z)})
        trim()
    return table.select("key", "n", "w", "x").mapInPandas(run, schema)


def usable(f: Fit) -> int:
    """Components that have variance."""
    return int((f.eigenvalues > 1e-12 * f.trace).sum()) if f.trace > 0 else 0


def whiten(vectors: DataFrame, cfg: Whitening = Whitening(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each vector that remains and component: vec_id, component,
    n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = whole(vectors, id_col, vec_col)
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    result = f"vec_id {vectors.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if sizes is None or sizes["dim"] == 0:
        return spark.createDataFrame([], result)
    dim = sizes["dim"]
    key = F.unhex(F.sha2(F.array_join("x", ",").cast("binary"), 256)).alias("key")
    rows = stored(rows.where(F.size("x") == dim).select("vec_id", "x", key), "vectors")
    table = stored(distinct(rows, cfg), "distinct-vectors")
    f = fit(table, dim, cfg)
    done = stored(projected(table, f, cfg), "projected-vectors")
    k = usable(f)
    error = None
    if k:
        centre = means(done, "z", k, cfg) / f.n
        error = float(np.abs(moments(done, "z", lambda z: z - centre, f.n, k, cfg) - np.eye(k)).max())
    total = done.agg(F.sum("n")).first()[0]
    hot = F.col("n") > total / HOT_SHARE
    hot_keys = F.broadcast(done.where(hot).select("key", "deviation", "z"))  # at most HOT_SHARE rows
    is_hot = F.broadcast(done.where(hot).select("key"))
    ids = rows.select("vec_id", "key")
    joined = ids.join(hot_keys, "key").unionByName(ids.join(is_hot, "key", "left_anti").join(done.where(~hot).select("key", "deviation", "z"), "key"))
    explained = [float(e / f.trace) if f.trace > 0 else None for e in f.eigenvalues]
    shares = F.array(*[F.lit(e).cast("double") for e in explained])
    # components behind the usable ones: no value in z
    d = joined.select("vec_id", "deviation", "z", F.posexplode(shares).alias("at", "explained"))
    return d.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(f.n).cast("long").alias("n"), "deviation",
                    F.get("z", F.col("at")).alias("whitened"), "explained", F.lit(error).cast("double").alias("identity_error"))


__all__ = ["Fit", "Whitening", "fit", "whiten", "whole"]
