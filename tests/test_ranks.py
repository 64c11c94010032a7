"""Exact quantiles and AUC from sampled ranges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import metrics as mt
from pluvio.operators import profile as pr
from pluvio.operators.ranks import RANGE, exact_quantiles, ranged, weight_below


@pytest.mark.parametrize("kind", ["spread", "crowded", "ties", "few"])
def test_quantiles_equal_numpy(spark, kind):
    rnd = np.random.default_rng(3)
    x = {"spread": rnd.standard_normal(5000) * 10.0 ** rnd.integers(-200, 200, 5000), "crowded": np.concatenate([rnd.random(4000) * 1e-9, [1e9]]),
         "ties": rnd.integers(0, 4, 3000).astype(float), "few": np.array([3.0, 1.0])}[kind]
    df = spark.createDataFrame([("hot", float(v)) for v in x] + [("one", 7.0), (None, 1.0), (None, 2.0), ("null", None)], "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: r.q for r in exact_quantiles(df, "x", probs, ["g"]).collect()}
    want = np.quantile(x, probs)
    assert set(got) == {"hot", "one", None} and np.allclose(got["hot"], want, rtol=1e-12, atol=0) and got["one"] == [7.0] * 6
    assert np.allclose(got[None], np.quantile([1.0, 2.0], probs))
    assert np.allclose(exact_quantiles(df.where("g = 'hot'"), "x", probs).first().q, want, rtol=1e-12, atol=0)


def test_describe_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), ("b", None)], "g string, x double")
    got = {r.g: (r.n, r.q25, r.q50, r.q75, r.max) for r in pr.describe(df, "x", ["g"]).collect()}
    assert got == {"a": (2, 1.75, 2.5, 3.25, 4.0), "b": (0, None, None, None, None)}
    assert pr.describe(df, "x").first().q50 == 2.5 and pr.describe(df.limit(0), "x").count() in (0, 1)
    assert pr.describe(df, "x", ["g"], approx=True).where("g = 'a'").first().q50 in (1.0, 4.0)


def test_ranges_follow_the_values(spark):
    """Scores that crowd under 1e-4 are split as evenly as any others (small
    ranges are not put together here)."""
    d = spark.range(20_000).select((F.rand(3) * 1e-4).alias("s"), F.lit(1).alias("w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranged(d, [], "s").groupBy(RANGE).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and max(sizes) < 2 * 20_000 / len(sizes)
    below = weight_below(d, [], "s", "w", "b").orderBy("s").select("b").toPandas()["b"].tolist()
    assert below == list(range(20_000))


def test_auc_of_crowded_scores(spark):
    rnd = np.random.default_rng(5)
    y, s = rnd.integers(0, 2, 2000), np.round(rnd.random(2000) * 1e-4, 6)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert mt.roc_auc(df, F.col("y") == 1, "s").first().auc == pytest.approx(want)
