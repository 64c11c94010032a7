"""Column-oriented JSON payloads (SRC1/SRC2/SRC7).

A payload looks like ``{"daily": {"time": ["2024-01-01", ...], "precipitation_sum": [...]}}``
(``hourly`` for hour grain, times ``2024-01-01T00:00``). Landed payload files
are read with an explicit schema, one file per task; arrays are turned into
rows with ``inline(arrays_zip(...))`` — no Python, no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_FORMATS = {"daily": "yyyy-MM-dd", "hourly": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def payload_schema(grain: str, variables: list[str]) -> T.StructType:
    inner = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))] +
                         [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables])
    return T.StructType([T.StructField(grain, inner)])


def read_payload_json(spark: SparkSession, path: str, grain: str, variables: list[str],
                      time_name: str = "fecha") -> DataFrame:
    """SRC1/SRC2 — landed payload files → typed rows (``fecha`` + variables)."""
    raw = spark.read.schema(payload_schema(grain, variables)).option("multiLine", True).json(path)
    return payload_to_rows(raw, grain=grain, time_name=time_name)


def payload_to_rows(df: DataFrame, grain: str, keys: list[str] | tuple = (),
                    time_name: str | None = None) -> DataFrame:
    """Explode the equal-length arrays of ``df[grain]`` into rows.

    Times are parsed as ``DATE`` (daily) or ``TIMESTAMP_NTZ`` (hourly); NaN
    readings become NULL.
    """
    st = df.schema[grain].dataType
    fields = [f.name for f in st.fields]
    values = [f for f in fields if f != "time"]
    zipped = F.arrays_zip(*[F.col(f"{grain}.{f}").alias(f) for f in fields])
    rows = df.select(*keys, F.inline(zipped))
    t = F.to_date("time") if grain == "daily" else F.to_timestamp_ntz(F.col("time"))
    name = time_name or ("fecha" if grain == "daily" else "ts")
    return rows.select(*keys, t.alias(name),
                       *[F.when(F.isnan(v), None).otherwise(F.col(v)).alias(v) for v in values])


def rows_to_payload(df: DataFrame, keys: list[str], time: str, values: list[str], grain: str,
                    block: int | None = None, block_key: str | None = None,
                    block_expr: Column | None = None) -> DataFrame:
    """Pack rows into column-oriented payloads, one per (keys, block).

    The block (``block_expr`` or ``block_key div block``) bounds the size of
    every payload, so packing never collects an unbounded group.
    """
    blk = block_expr if block_expr is not None else F.floor(F.col(block_key) / block)
    packed = df.groupBy(*keys, blk.alias("_blk")).agg(
        F.sort_array(F.collect_list(F.struct(F.col(time).alias("t"), *[F.col(v) for v in values])))
        .alias("_rows"))
    fmt = TIME_FORMATS[grain]
    def field(name):
        return lambda r: r[name].cast("double")

    body = F.struct(F.transform("_rows", lambda r: F.date_format(r["t"], fmt)).alias("time"),
                    *[F.transform("_rows", field(v)).alias(v) for v in values])
    return packed.select(*keys, body.alias(grain))
