"""Boosted trees of a small table, all grown in one task (ML11, ML12).

MLlib grows every level of every tree by a job of its own, which for a table of
a few thousand rows is nearly all overhead. The estimators here do what
``GBTClassifier`` and ``GBTRegressor`` do, step by step: the same thresholds
(up to ``MOST_ROWS`` rows MLlib looks at every row for them), the same draws of
rows and features for a seed and a layout of rows over partitions, the same
sums in the same order, the same choice among equal gains. They differ from
MLlib's in the last digits at most. Larger tables are for MLlib, which spreads
the rows over tasks.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 10_000  # MLlib draws a sample for its thresholds from larger tables
INVALID = np.finfo(float).min  # gain of a split that is not allowed
EPSILON = 2.0 ** -52  # a child with less impurity is a leaf
COLUMNS = {"labelCol", "featuresCol", "weightCol"}
TREE_PARAMS = {"maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "subsamplingRate", "featureSubsetStrategy", "seed", "maxBins", "lossType"}
SCORED_ROWS = 1_000  # rows scored at a time, so that rows × trees stays small

_M64 = (1 << 64) - 1


def _u32(x):
    return x & np.uint64(0xFFFFFFFF)


def _rotl(x, n: int):
    return _u32(x << np.uint64(n)) | (x >> np.uint64(32 - n))


def _murmur(words: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    """MurmurHash3 of two 32-bit words, as Scala's ``bytesHash`` of 8 bytes."""
    for k in words:
        k = _u32(_rotl(_u32(k * np.uint64(0xCC9E2D51)), 15) * np.uint64(0x1B873593))
        h = _u32(_rotl(h ^ k, 13) * np.uint64(5) + np.uint64(0xE6546B64))
    h = h ^ np.uint64(8)
    h = _u32((h ^ (h >> np.uint64(16))) * np.uint64(0x85EBCA6B))
    h = _u32((h ^ (h >> np.uint64(13))) * np.uint64(0xC2B2AE35))
    return h ^ (h >> np.uint64(16))


def xorshift_states(seeds: np.ndarray) -> np.ndarray:
    """First states of Spark's ``XORShiftRandom`` for 64-bit seeds."""
    seeds = np.asarray(seeds, "uint64")
    swapped = seeds.byteswap()  # the bytes are hashed from the high end
    words = [_u32(swapped), swapped >> np.uint64(32)]
    low = _murmur(words, np.full(seeds.shape, 0x3C074A61, "uint64"))
    return (_murmur(words, low) << np.uint64(32)) | low


def xorshift_doubles(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(next states, next doubles) of ``XORShiftRandom``."""
    def step(s):
        s = s ^ (s << np.uint64(21))
        s = s ^ (s >> np.uint64(35))
        return s ^ (s << np.uint64(4))
    a = step(s)
    b = step(a)
    bits = ((a & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (b & np.uint64((1 << 27) - 1))
    return b, bits.astype("float64") * 2.0 ** -53


def java_longs(seeds: np.ndarray, n: int) -> np.ndarray:
    """(seeds, n) first longs of ``java.util.Random``, as unsigned numbers."""
    mult, mask = 0x5DEECE66D, (1 << 48) - 1
    jumps, a, c = [], 1, 0
    for _ in range(2 * n):
        a, c = a * mult & mask, (c * mult + 0xB) & mask
        jumps.append((a, c))
    a, c = (np.array(x, "uint64") for x in zip(*jumps))
    state = (np.asarray(seeds, "uint64") ^ np.uint64(mult)) & np.uint64(mask)
    ints = ((state[:, None] * a + c) & np.uint64(mask)) >> np.uint64(16)
    high, low = ints[:, ::2], ints[:, 1::2]
    low = low | (np.uint64(0xFFFFFFFF00000000) * (low >> np.uint64(31)))  # a signed int is added
    return (high << np.uint64(32)) + low


def bagged_rows(part: np.ndarray, rate: float, seeds: np.ndarray) -> np.ndarray:
    """(trees, rows): is the row in the tree's sample? Rows are in the order
    of their partitions, each of which draws from a stream of its own."""
    out = np.ones((len(seeds), len(part)), bool)
    if rate >= 1.0:
        return out
    for p in np.unique(part):
        at = np.flatnonzero(part == p)
        s = xorshift_states(seeds + np.uint64(p + 1))
        for i in at:
            s, x = xorshift_doubles(s)
            out[:, i] = x < rate
    return out


def feature_subsets(seeds: np.ndarray, nodes: int, n: int, k: int) -> np.ndarray:
    """(trees, nodes, k): the features that a tree's first, second, ... node
    looks at, in MLlib's order (a reservoir sample of ``k`` of ``n``)."""
    out = np.broadcast_to(np.arange(k, dtype="int16"), (len(seeds), nodes, k))
    if k == n:
        return out
    out = out.copy().reshape(-1, k)
    s = xorshift_states(java_longs(seeds, nodes).ravel())
    for item in range(k, n):
        s, x = xorshift_doubles(s)
        at = (x * (item + 1)).astype("int64")
        hit = np.flatnonzero(at < k)
        out[hit, at[hit]] = item
    return out.reshape(len(seeds), nodes, k)


def thresholds(x: np.ndarray, w: np.ndarray, total: float, bins: int) -> np.ndarray:
    """MLlib's candidate thresholds of a column: between neighbouring values,
    all of them or those nearest to equal shares of the weight."""
    seen = x != 0.0
    values, at = np.unique(x[seen], return_inverse=True)
    weight = np.bincount(at, w[seen], len(values))
    if total - weight.sum() > EPSILON * seen.sum() * 100:  # zeros count as what is left
        i = np.searchsorted(values, 0.0)
        values, weight = np.insert(values, i, 0.0), np.insert(weight, i, total - weight.sum())
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) <= bins - 1:
        return between
    stride, out, count = total / bins, [], weight[0]
    target = stride
    for i in range(1, len(values)):
        before, count = count, count + weight[i]
        if abs(before - target) < abs(count - target):
            out.append(between[i - 1])
            target += stride
    return np.array(out)


def _impurity(w, s, q):
    return np.where(w == 0.0, 0.0, (q - s * s / w) / w)


class Grower:
    """Grows trees over binned rows; the rows are in partition order."""

    def __init__(self, x, w, part, depth: int, min_rows: int, bins: int):
        self.n, self.f = x.shape
        self.depth, self.min_rows, self.w = depth, min_rows, w
        bins = min(bins, self.n)
        total = np.cumsum(np.bincount(part, w))[-1]  # added up within a partition first
        self.cuts = [thresholds(x[:, j], w, total, bins) for j in range(self.f)]
        self.usable = np.array([len(c) > 0 for c in self.cuts])
        self.bins = max(2, max(len(c) for c in self.cuts) + 1)
        self.bin = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)
        self.cell = self.bin + np.arange(self.f) * self.bins
        self._cells, self._terms = np.empty_like(self.cell), np.empty((self.n, self.f))
        self.cut = np.zeros((self.f, self.bins))
        for j, c in enumerate(self.cuts):
            self.cut[j, :len(c)] = c
        self.plain = bool((w == 1.0).all())
        self.ends = np.flatnonzero(np.diff(part)) + 1

    def _added(self, cells, v, size: int):
        terms = self._terms[:len(v)]
        terms[...] = v[:, None]
        return np.bincount(cells, terms.ravel(), size)

    def _sums(self, rows, slot, k: int, y):
        """(4, k, features, bins) running totals over the bins: rows, weight,
        weight·y and weight·y²; partition by partition, as MLlib adds them."""
        size = k * self.f * self.bins
        out = np.zeros((4, size))
        cuts = [0, *np.searchsorted(rows, self.ends), len(rows)]
        for a, b in zip(cuts, cuts[1:]):
            r = rows[a:b]
            if not len(r):
                continue
            cells = self.cell.take(r, 0, self._cells[:len(r)], "clip")
            cells += (slot[a:b] * (self.f * self.bins))[:, None]
            cells, w = cells.ravel(), self.w[r]
            wy = w * y[r]
            count = np.bincount(cells, minlength=size)
            out[0] += count
            out[1] += count if self.plain else self._added(cells, w, size)
            out[2] += self._added(cells, wy, size)
            out[3] += self._added(cells, wy * y[r], size)
        out = out.reshape(4, k, self.f, self.bins)
        return np.cumsum(out, axis=3, out=out)

    def tree(self, rows, y, subsets):
        """(feature, threshold, left child, value, bin) of the nodes; the
        right child follows the left, a leaf has feature -1."""
        feature, cut, left, value, split = [-1], [0.0], [-1], [0.0], [0]
        slot = np.zeros(len(rows), "int64")
        nodes, stats, taken = [0], None, 0  # of the level, in MLlib's order; stats: (4, nodes)
        for level in range(self.depth + 1):
            if not nodes:
                break
            looked = subsets[taken:taken + len(nodes)].astype("int64")
            taken += len(nodes)
            if stats is not None:  # a node with too few rows for two children stays a leaf; its features are drawn all the same
                large = np.flatnonzero(stats[0] >= 2 * self.min_rows)
                if not len(large):
                    break
                slot = np.where(stats[0] >= 2 * self.min_rows, np.cumsum(stats[0] >= 2 * self.min_rows) - 1, -1)[slot]
                rows, slot = rows[slot >= 0], slot[slot >= 0]
                nodes, looked, stats = [nodes[i] for i in large], looked[large], stats[:, large]
            k = len(nodes)
            at = np.arange(k)
            cum = self._sums(rows, slot, k, y)
            total = cum[..., -1:]
            if stats is None:
                first = looked[0][self.usable[looked[0]]]
                j = first[0] if len(first) else 0
                head = cum[:, :, j, 0]
                stats = head + (cum[:, :, j, -1] - head)
                value[0] = float(stats[2, 0] / stats[1, 0]) if stats[1, 0] else 0.0
            lo = cum[..., :-1]
            hi = total - lo
            w = lo[1] + hi[1]
            with np.errstate(divide="ignore", invalid="ignore"):
                low, high = _impurity(*lo[1:]), _impurity(*hi[1:])
                gain = _impurity(*stats[1:])[:, None, None] - lo[1] / w * low - hi[1] / w * high
            gain[(lo[0] < self.min_rows) | (hi[0] < self.min_rows) | (gain < 0.0)] = INVALID
            best = gain.argmax(2)
            of = np.take_along_axis(gain, best[..., None], 2)[..., 0]
            pick = looked[at, of[at[:, None], looked].argmax(1)]
            won = best[at, pick]
            top = of[at, pick]
            grows = ~(top <= 0.0) & (level < self.depth)
            low, high = low[at, pick, won], high[at, pick, won]
            lo, hi = lo[:, at, pick, won], hi[:, at, pick, won]
            nxt, goes = [], np.full((k, 2), -1)
            for i in np.flatnonzero(grows):
                node, a = nodes[i], len(feature)
                feature[node], split[node], left[node], cut[node] = int(pick[i]), int(won[i]), a, float(self.cut[pick[i], won[i]])
                for side, (st, imp) in enumerate(((lo, low), (hi, high))):
                    feature.append(-1), cut.append(0.0), left.append(-1), split.append(0)
                    value.append(float(st[2, i] / st[1, i]) if st[1, i] else 0.0)
                    if level + 1 < self.depth and not abs(imp[i]) < EPSILON:
                        nxt.append((a + side, i, side))
            nxt.reverse()
            if not nxt:
                break
            for s, (_, i, side) in enumerate(nxt):
                goes[i, side] = s
            right = self.bin[rows, pick[slot]] > won[slot]
            slot = goes[slot, right.astype("int64")]
            kept = slot >= 0
            rows, slot = rows[kept], slot[kept]
            nodes = [x[0] for x in nxt]
            stats = np.stack([(lo, hi)[side][:, i] for _, i, side in nxt], 1)
        return tuple(np.array(c) for c in (feature, cut, left, value, split))

    def values(self, tree):
        """The tree's value for every row."""
        feature, _, left, value, split = tree
        at, rows = np.zeros(self.n, "int64"), np.arange(self.n)
        for _ in range(self.depth):
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            at = np.where(inner, left[at] + (self.bin[rows, f] > split[at]), at)
        return value[at]


def _residual(loss: str, y, pred):
    if loss == "logistic":  # math.exp agrees with the JVM's to the last digit far more often than numpy's
        return 4.0 * y / (1.0 + np.fromiter(map(math.exp, (2.0 * y * pred).tolist()), float, len(y)))
    if loss == "absolute":
        return np.where(y - pred < 0, -1.0, 1.0)
    return 2.0 * (y - pred)


def boosted(x, y, w, part, p: dict) -> dict:
    """All trees of a fit, one after another: ``start`` of each tree in the
    joined node columns, ``weight`` of each tree."""
    order = np.argsort(part, kind="stable")
    x, y, w, part = x[order], y[order], w[order], part[order]
    g = Grower(x, w, part, p["maxDepth"], p["minInstancesPerNode"], p["maxBins"])
    seeds = np.array([(p["seed"] + m) & _M64 for m in range(p["maxIter"])], "uint64")
    bags = bagged_rows(part, p["subsamplingRate"], seeds)
    subsets = feature_subsets(seeds, max(1, 2 ** p["maxDepth"] - 1), g.f, p["features"](g.f))
    pred, label, trees = np.zeros(g.n), y, []
    for m in range(p["maxIter"]):
        trees.append(g.tree(np.flatnonzero(bags[m]), label, subsets[m]))
        pred = pred + (1.0 if m == 0 else p["stepSize"]) * g.values(trees[-1])
        label = _residual(p["loss"], y, pred)
    columns = [np.concatenate([t[c] for t in trees]) for c in range(4)]
    start = np.cumsum([0, *(len(t[0]) for t in trees)])[:-1]
    weight = np.full(len(trees), p["stepSize"])
    weight[0] = 1.0
    return dict(feature=columns[0].astype("int32"), cut=columns[1], left=columns[2].astype("int32"), value=columns[3],
                start=start.astype("int32"), weight=weight, depth=np.array(p["maxDepth"]))


def scores(x: np.ndarray, t: dict) -> np.ndarray:
    """Weighted sum of the trees' values for each row."""
    out = np.empty(len(x))
    for a in range(0, len(x), SCORED_ROWS):
        part = x[a:a + SCORED_ROWS]
        at = np.broadcast_to(t["start"], (len(part), len(t["start"])))
        for _ in range(int(t["depth"])):
            f = t["feature"][at]
            right = ~(np.take_along_axis(part, np.maximum(f, 0), 1) <= t["cut"][at])
            at = np.where(f >= 0, t["start"] + t["left"][at] + right, at)
        out[a:a + SCORED_ROWS] = t["value"][at] @ t["weight"]
    return out


def _matrix(col) -> np.ndarray:
    """A list column as a matrix."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _features_a_node(strategy: str):
    """MLlib's number of features that a node looks at, of the strategies
    that the knobs can name."""
    if strategy in ("all", "auto"):
        return lambda n: n
    share = float(strategy)
    if not 0.0 < share <= 1.0 or strategy.isdigit():
        raise ValueError(f"feature subset strategy {strategy!r} is for MLlib")
    return lambda n: int(np.ceil(share * n))


def _grow(est, dataset: DataFrame, loss: str) -> bytes:
    """The trees of an estimator's fit, grown in one task and packed."""
    other = {p.name for p in est.extractParamMap() if est.isSet(p)} - COLUMNS - TREE_PARAMS
    if other:
        raise ValueError(f"{sorted(other)} are for MLlib")
    p = {n: est.getOrDefault(n) for n in TREE_PARAMS - {"lossType"}}
    p |= {"loss": loss, "features": _features_a_node(p["featureSubsetStrategy"])}
    weight = F.col(est.getWeightCol()) if est.isSet("weightCol") else F.lit(1.0)
    rows = dataset.select(vector_to_array(F.col(est.getFeaturesCol())).alias("x"), F.col(est.getLabelCol()).cast("double").alias("y"),
                          weight.cast("double").alias("w"), F.spark_partition_id().alias("part"))

    def grow(batches):
        t = pa.Table.from_batches(list(batches))
        if t.num_rows > MOST_ROWS:
            raise ValueError(f"{t.num_rows} rows are for MLlib")
        y = t["y"].to_numpy()
        if not t.num_rows or t["y"].null_count or t["w"].null_count or np.isnan(y).any() or (loss == "logistic" and not np.isin(y, (0, 1)).all()):
            raise ValueError("no rows, or labels that cannot be fitted")
        if loss == "logistic":
            y = y * 2 - 1
        out = io.BytesIO()
        np.savez_compressed(out, **boosted(_matrix(t["x"]), y, t["w"].to_numpy(), t["part"].to_numpy(), p))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["trees"])

    packed = rows.coalesce(1).mapInArrow(grow, "trees binary").collect()
    if not packed:
        raise ValueError("no rows to fit")
    return bytes(packed[0][0])


def unpacked(trees: bytes) -> dict:
    return dict(np.load(io.BytesIO(trees)))


class GrownTrees(Model):
    """Fitted trees; ``transform`` adds the columns that MLlib's models add."""

    def __init__(self, trees: bytes, features: str = "features", classes: bool = False):
        super().__init__()
        self.trees, self.features, self.classes = trees, features, classes

    def score(self) -> Column:
        trees = self.trees

        @F.arrow_udf("double")
        def score(x):
            return pa.array(scores(_matrix(x), unpacked(trees)))
        return score(vector_to_array(F.col(self.features)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if not self.classes:
            return dataset.withColumn("prediction", self.score())
        d = dataset.withColumn("_margin", self.score())
        m = F.col("_margin")
        dry = 1.0 / (1.0 + F.exp(2.0 * m))
        return d.withColumns({"rawPrediction": array_to_vector(F.array(-m, m)), "probability": array_to_vector(F.array(dry, 1.0 - dry)),
                              "prediction": (m > 0).cast("double")}).drop("_margin")


class TaskGBTClassifier(GBTClassifier):
    """``GBTClassifier`` for up to ``MOST_ROWS`` rows, in one task."""

    def _fit(self, dataset: DataFrame) -> GrownTrees:
        return GrownTrees(_grow(self, dataset, "logistic"), self.getFeaturesCol(), classes=True)


class TaskGBTRegressor(GBTRegressor):
    """``GBTRegressor`` for up to ``MOST_ROWS`` rows, in one task."""

    def _fit(self, dataset: DataFrame) -> GrownTrees:
        return GrownTrees(_grow(self, dataset, self.getLossType()), self.getFeaturesCol())
