"""Typed params ladder, map merge, payload files."""

import json

from pyspark.sql import functions as F

from pluvio.operators import runs as rn
from pluvio.sources import payload


def test_typed_param_ladder(spark):
    vals = [None, "True", " false ", "7", "0.30", "1e3", " x ", "", "-12", "3.", "abc1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [tuple(r) for r in df.orderBy("i").select(rn.typed_param(F.col("v")).alias("t")).select("t.*").collect()]
    kinds = [g[0] for g in got]
    assert kinds == [None, "bool", "bool", "int", "float", "float", "string", "string", "int", "float", "string"]
    assert got[1][1] is True and got[2][1] is False and got[3][2] == 7 and got[5][3] == 1000.0
    assert got[6][4] == "x" and got[7][4] == ""


def test_merge_maps_right_wins(spark):
    df = spark.range(1).select(rn.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")),
                                             F.create_map(F.lit("b"), F.lit("9"), F.lit("c"), F.lit("3"))).alias("m"))
    assert df.first()["m"] == {"a": "1", "b": "9", "c": "3"}


def test_strip_and_drop(spark):
    df = spark.range(1).select(F.create_map(F.lit("clf_depth"), F.lit("3"), F.lit("reg_depth"), F.lit("5"),
                                            F.lit("clf_threshold"), F.lit("0.3")).alias("p"))
    m = df.select(rn.drop_keys(rn.strip_prefix(F.col("p"), "clf_")).alias("m")).first()["m"]
    assert m == {"depth": "3"}


def test_payload_file_roundtrip(spark):
    import tempfile
    d = tempfile.mkdtemp(prefix="pluvio-payload-")  # a local file written by the test itself
    with open(f"{d}/p1.json", "w") as f:
        json.dump({"daily": {"time": ["2024-01-01", "2024-01-02", "2024-01-03"],
                             "precipitation_sum": [0.0, float("nan"), 3.5]}}, f)
    rows = payload.read_payload_json(spark, d, "daily", ["precipitation_sum"]).orderBy("fecha").collect()
    assert [r["precipitation_sum"] for r in rows] == [0.0, None, 3.5]
    assert str(rows[0]["fecha"]) == "2024-01-01"
