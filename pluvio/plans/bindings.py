"""Stand-in series built from the driver's tables.

The driver tables hold no weather, so each operator runs on a series Spark
derives from them (all reads are whole tables; the work grows with them):

``D``  daily series from ``lineitem`` by ship day, key ``l_returnflag``
       (``precip`` = sum of quantities — integral, so sums are exact);
``H``  ``events`` as readings, key ``event_type``; WMO code = ``$.k`` of props;
``P``  forecast vs actual: actuals = orders per day, predictions = lineitem
       lines per day;
``S``  scored rows: one per order, with a probability and an amount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.operators.rollup import aggregate_to_daily
from pluvio.series import nan_to_null

# Stand-in parameters (units of the stand-in values, not mm).
D_DRY_THRESHOLD = 150.0   # a day with sum(l_quantity) <= 150 counts as "dry"
P_WET_THRESHOLD = 6.0     # actual/predicted value above this counts as "wet"
P_PEAK_THRESHOLD = 9.0    # "peak" days
S_WET_THRESHOLD = 0.5     # scored rows: amount above this is a positive
S_PEAK_THRESHOLD = 20.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC4 — a driver table as a distributed DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_lineitem(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """D — one row per (return flag, ship day)."""
    li = table(spark, sf_dir, "lineitem")
    keys = ["series"] if keyed else []
    if keyed:
        li = li.withColumnRenamed("l_returnflag", "series")
    d = aggregate_to_daily(
        li, {"l_quantity": ["sum"], "l_extendedprice": ["mean"], "l_discount": ["max"],
             "l_tax": ["min"], "l_orderkey": ["count"]},
        time="l_shipdate", keys=keys)
    d = d.select(*keys, "fecha",
                 F.col("l_quantity_sum").alias("precip"),
                 F.col("l_orderkey_count").alias("n_lines"),
                 F.col("l_extendedprice_mean").alias("price_mean"),
                 F.col("l_discount_max").alias("disc_max"),
                 F.col("l_tax_min").alias("tax_min"),
                 (F.col("l_quantity_sum").cast("long") % 100).cast("double").alias("weather_code"))
    return nan_to_null(d)


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H — readings keyed by event type, with the WMO-like code ``k``."""
    ev = table(spark, sf_dir, "events")
    return nan_to_null(ev.select(
        "event_type", "ts", "value", "user_id",
        F.get_json_object("props", "$.k").cast("double").alias("k")))


def actuals_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P (actuals) — orders per day as the observed amount."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.to_date("o_orderdate").alias("fecha"))
            .agg(F.count(F.lit(1)).cast("double").alias("mm_actual"))
            .withColumn("did_rain", (F.col("mm_actual") > P_WET_THRESHOLD).cast("int")))


def predictions_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P (predictions) — lineitem lines per day, scaled, as the forecast."""
    li = table(spark, sf_dir, "lineitem")
    n = F.count(F.lit(1))
    return (li.groupBy(F.to_date("l_shipdate").alias("fecha"))
            .agg(F.round(F.least(n / 48.0, F.lit(1.0)), 4).alias("prob_rain"),
                 F.round(n / 4.0, 3).alias("mm_predicted"))
            .withColumn("will_rain", (F.col("prob_rain") > 0.5).cast("int"))
            .withColumn("model_version", F.lit("v1"))
            .withColumn("threshold_used", F.lit(0.5)))


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S — one scored row per order: ``y`` actual amount, ``y_pred`` predicted
    amount, ``prob`` predicted probability (two decimals, with ties); group
    key ``o_orderpriority``. Built with floor/products only, so every engine
    computes bit-identical values."""
    o = table(spark, sf_dir, "orders")
    prob = F.floor(F.col("o_totalprice") / 6000) / 100.0
    return o.select(
        "o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("yr"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") / 10000.0)
         .otherwise(F.lit(0.0)).alias("y"),
        prob.alias("prob"),
        (prob * (F.col("o_custkey") % 50)).alias("y_pred"))


# Weather-shaped stand-ins under the daily/hourly API names: every daily and
# hourly variable of the reference exists, so its default pipeline runs whole.
# (name, Spark expression builder, DuckDB expression) over lineitem columns;
# builders are lambdas so importing this module needs no Spark session.
WEATHER_DAILY = [
    ("precipitation_sum", lambda: F.sum("l_quantity"), "SUM(l_quantity)"),
    ("precipitation_hours", lambda: F.count(F.lit(1)).cast("double"), "CAST(COUNT(*) AS DOUBLE)"),
    ("temperature_2m_max", lambda: F.max("l_extendedprice") / 1000, "MAX(l_extendedprice) / 1000"),
    ("temperature_2m_min", lambda: F.min("l_extendedprice") / 1000, "MIN(l_extendedprice) / 1000"),
    ("temperature_2m_mean", lambda: F.avg("l_extendedprice") / 1000, "AVG(l_extendedprice) / 1000"),
    ("windspeed_10m_max", lambda: F.max("l_discount") * 100, "MAX(l_discount) * 100"),
    ("windgusts_10m_max", lambda: F.max("l_tax") * 100, "MAX(l_tax) * 100"),
    ("winddirection_10m_dominant", lambda: (F.sum("l_quantity").cast("long") % 360).cast("double"),
     "CAST(CAST(SUM(l_quantity) AS BIGINT) % 360 AS DOUBLE)"),
    ("shortwave_radiation_sum", lambda: F.sum("l_tax") * 10, "SUM(l_tax) * 10"),
    ("et0_fao_evapotranspiration", lambda: F.avg("l_discount") * 10, "AVG(l_discount) * 10"),
    ("weathercode", lambda: (F.sum("l_quantity").cast("long") % 100).cast("double"),
     "CAST(CAST(SUM(l_quantity) AS BIGINT) % 100 AS DOUBLE)"),
]
WEATHER_HOURLY = [
    ("pressure_msl", lambda: 990 + F.col("l_tax") * 500, "990 + l_tax * 500"),
    ("surface_pressure", lambda: 950 + F.col("l_tax") * 400, "950 + l_tax * 400"),
    ("relative_humidity_2m", lambda: F.col("l_discount") * 900, "l_discount * 900"),
    ("dew_point_2m", lambda: F.col("l_quantity") / 5, "l_quantity / 5"),
    ("vapour_pressure_deficit", lambda: F.col("l_tax") * 20, "l_tax * 20"),
    ("cloud_cover", lambda: F.col("l_quantity") * 2, "l_quantity * 2"),
    ("cloud_cover_low", lambda: (F.col("l_partkey") % 100).cast("double"), "CAST(l_partkey % 100 AS DOUBLE)"),
    ("cloud_cover_mid", lambda: (F.col("l_suppkey") % 100).cast("double"), "CAST(l_suppkey % 100 AS DOUBLE)"),
    ("cloud_cover_high", lambda: (F.col("l_orderkey") % 100).cast("double"), "CAST(l_orderkey % 100 AS DOUBLE)"),
    ("wind_speed_10m", lambda: F.col("l_extendedprice") / 5000, "l_extendedprice / 5000"),
    ("wind_direction_10m", lambda: (F.col("l_partkey") % 360).cast("double"), "CAST(l_partkey % 360 AS DOUBLE)"),
    ("wind_gusts_10m", lambda: F.col("l_extendedprice") / 4000, "l_extendedprice / 4000"),
]


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily readings per (return flag, ship day) under the daily API names."""
    li = table(spark, sf_dir, "lineitem")
    return nan_to_null(li.groupBy(F.col("l_returnflag").alias("series"), F.to_date("l_shipdate").alias("fecha"))
                       .agg(*[e().alias(n) for n, e, _ in WEATHER_DAILY]))


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings: each line item is a reading at ship day + line number hours."""
    li = table(spark, sf_dir, "lineitem")
    ts = F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate"))
    return nan_to_null(li.select(F.col("l_returnflag").alias("series"), ts.alias("ts"),
                                 *[e().alias(n) for n, e, _ in WEATHER_HOURLY]))
