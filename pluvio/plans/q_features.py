"""Queries: sources, rollups and window features (SRC1-4, AGG1-3, AGG15-16,
JOIN1, PRJ1-6, FLT1-7, WIN1-5, FN1-5, ML17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.operators import features as fe
from pluvio.operators import profile
from pluvio.operators.rollup import aggregate_to_daily, join_daily
from pluvio.plans import bindings as b
from pluvio.plans import sqlgen as sg
from pluvio.plans.registry import present, query, rnd
from pluvio.series import SeriesSpec
from pluvio.session import tune_optimizer
from pluvio.sources import payload

D_SPEC = SeriesSpec(keys=("series",), time="fecha")
D1_SPEC = SeriesSpec(keys=(), time="fecha", chunk_rows=365)
D_VARS = ["precip", "n_lines", "price_mean", "disc_max", "tax_min", "weather_code"]
D_ROLL = ["precip", "price_mean"]
D_DOUBLES = ["precip", "price_mean", "disc_max", "tax_min", "weather_code"]
D_CFG = fe.FeatureConfig(rename={}, lag_vars=D_VARS, rolling_vars=D_ROLL,
                         streak_col="precip", streak_threshold=b.D_DRY_THRESHOLD,
                         target_col="precip", wmo_col="weather_code_lag1")
ROLL_NAMES = [f"{c}_{t}_{w}" for c in D_ROLL for w in fe.ROLLING_WINDOWS for t in ("rmean", "rstd", "rmax")]
SEASON_INTS = ["estacion_verano", "estacion_otoño", "estacion_invierno", "estacion_primavera"]
SEASON_DBL = ["mes_sin", "mes_cos", "dia_año_sin", "dia_año_cos"]
WMO_COLS = [f"wmo_{c}" for c in fe.WMO_CATEGORIES]


# D arrives under the daily API names, so the pipeline's rename (PRJ1) runs.
D_API_NAMES = {"precip": "precipitation_sum", "weather_code": "weathercode"}
D_CFG.rename = {k: v for k, v in fe.RENAME_MAP.items()}


def _feature_table(spark, sf_dir, spec=D_SPEC):
    tune_optimizer(spark)
    raw = b.daily_lineitem(spark, sf_dir).withColumnsRenamed(D_API_NAMES)
    return fe.build_features(raw, spec, D_CFG)


def _feature_sql(part="series", d_sql=sg.D_SQL):
    o = "fecha"
    lag_cols = sg.lag_sql(D_VARS, part, o)
    roll = sg.rolling_sql(D_ROLL, part, o)
    inner = f"SELECT *, {', '.join(lag_cols + roll)}, LEAD(precip, 1) {sg.over(part, o)} AS precip_t1 FROM d"
    streak = sg.streak_sql(f"({inner})", "precip", b.D_DRY_THRESHOLD, part, o)
    dbl = D_DOUBLES + [f"{c}_lag1" for c in D_DOUBLES] + ROLL_NAMES + ["precip_t1"]
    keep = ([part] if part else []) + ["fecha", "n_lines", "n_lines_lag1", "racha_seca"]
    return f"""
WITH d AS ({d_sql}),
f AS ({streak})
SELECT {', '.join(keep)}, {sg.round_cols(dbl)}, {', '.join(_season_wmo())}
FROM (SELECT *, {', '.join(sg.seasonal_sql('fecha'))} FROM f) g
"""


def _season_wmo():
    out = [f"{sg.rnd(sg.q(n))} AS {sg.q(n)}" for n in SEASON_DBL]
    out += [sg.q(n) for n in SEASON_INTS]
    out += sg.wmo_onehot_sql("weather_code_lag1")
    return out


@query("feature_table", _feature_sql())
def q_feature_table(spark, sf_dir):
    """ML17 + PRJ1 — the full feature table of every series (API names
    renamed, one shared window exchange)."""
    return present(_feature_table(spark, sf_dir))


@query("feature_table_chunked", _feature_sql())
def q_feature_table_chunked(spark, sf_dir):
    """ML17 through the chunk+halo plan with keys: windows run per
    (series, 256-row chunk), so a series of any length or skew is split
    over many bounded tasks; same result as ``feature_table``."""
    return present(_feature_table(spark, sf_dir, SeriesSpec(keys=("series",), time="fecha", chunk_rows=256)))


# ----------------------------- single features -----------------------------

def _d_window_sql(cols_sql: list[str], dbl: list[str], ints: list[str] = (), part="series", d_sql=sg.D_SQL):
    base = ([part] if part else []) + ["fecha"]
    return f"""
WITH d AS ({d_sql})
SELECT {', '.join(base + list(ints))}{', ' if dbl else ''}{sg.round_cols(dbl)}
FROM (SELECT *, {', '.join(cols_sql)} FROM d) x
"""


def _d_select(df, cols, keyed=True):
    base = (["series"] if keyed else []) + ["fecha"]
    return present(df.select(*base, *cols))


@query("lag_features", _d_window_sql(sg.lag_sql(D_VARS, "series", "fecha"),
                                      [f"{c}_lag1" for c in D_DOUBLES], ["n_lines_lag1"]))
def q_lag_features(spark, sf_dir):
    """WIN1 — lag-1 of every daily variable, per series."""
    cfg = fe.FeatureConfig(rename={}, lag_vars=D_VARS, rolling_vars=[], streak_col=None,
                           target_col=None, wmo_col=None)
    d = fe.build_features(b.daily_lineitem(spark, sf_dir), D_SPEC, cfg)
    return _d_select(d, [f"{c}_lag1" for c in D_VARS])


_DIFFS = {"precip": {"precip_diff1": 1, "precip_diff2": 2}}


@query("diff_features", _d_window_sql(
    [f"precip - LAG(precip, 1) {sg.over('series', 'fecha')} AS precip_diff1",
     f"precip - LAG(precip, 2) {sg.over('series', 'fecha')} AS precip_diff2"],
    ["precip_diff1", "precip_diff2"]))
def q_diff_features(spark, sf_dir):
    """WIN2 — one- and two-row differences."""
    d = fe.with_window_features(
        b.daily_lineitem(spark, sf_dir), D_SPEC,
        {"diff": lambda sw: fe.diff_columns(sw, "precip", _DIFFS["precip"])}, back=2, fwd=0)
    return _d_select(d, ["precip_diff1", "precip_diff2"])


@query("rolling_features", _d_window_sql(sg.rolling_sql(D_ROLL, "series", "fecha"), ROLL_NAMES))
def q_rolling_features(spark, sf_dir):
    """WIN3 — rolling mean/std/max over the 7/14/30 previous rows (full windows)."""
    d = fe.with_window_features(
        b.daily_lineitem(spark, sf_dir), D_SPEC,
        {"roll": lambda sw: fe.rolling_columns(sw, D_ROLL)}, back=30, fwd=0)
    return _d_select(d, ROLL_NAMES)


@query("dry_streak", f"WITH d AS ({sg.D_SQL}) SELECT series, fecha, racha_seca FROM ("
                     + sg.streak_sql("d", "precip", b.D_DRY_THRESHOLD, "series", "fecha") + ") s")
def q_dry_streak(spark, sf_dir):
    """WIN4 — consecutive dry rows up to the previous row (loop-free)."""
    d = fe.with_window_features(b.daily_lineitem(spark, sf_dir), D_SPEC, {}, back=1, fwd=0,
                                streaks=[("racha_seca", "precip", b.D_DRY_THRESHOLD)])
    return d.select("series", "fecha", "racha_seca")


@query("next_target", _d_window_sql([f"LEAD(precip, 1) {sg.over('series', 'fecha')} AS precip_t1"],
                                     ["precip_t1"]))
def q_next_target(spark, sf_dir):
    """WIN5 — next-row target, NULL on the last row of every series."""
    d = fe.with_window_features(b.daily_lineitem(spark, sf_dir), D_SPEC,
                                {"t": lambda sw: fe.target_column(sw, "precip", "precip_t1")},
                                back=0, fwd=1)
    return _d_select(d, ["precip_t1"])


# ---------------------- one long series: chunk + halo -----------------------

@query("rolling_single_series", _d_window_sql(
    sg.rolling_sql(D_ROLL, "", "fecha") + sg.lag_sql(["precip"], "", "fecha")
    + [f"LEAD(precip, 1) {sg.over('', 'fecha')} AS precip_t1"],
    ROLL_NAMES + ["precip_lag1", "precip_t1"], part="", d_sql=sg.D1_SQL))
def q_rolling_single_series(spark, sf_dir):
    """WIN3 + WIN1 + WIN5 on one global series through the chunk+halo plan
    (365-row chunks): no task holds more than one chunk plus its halo."""
    d = fe.with_window_features(
        b.daily_lineitem(spark, sf_dir, keyed=False), D1_SPEC,
        {"roll": lambda sw: fe.rolling_columns(sw, D_ROLL),
         "lag": lambda sw: fe.lag_columns(sw, ["precip"]),
         "t": lambda sw: fe.target_column(sw, "precip", "precip_t1")}, back=30, fwd=1)
    return _d_select(d, ROLL_NAMES + ["precip_lag1", "precip_t1"], keyed=False)


@query("streak_single_series", "WITH d AS (" + sg.D1_SQL + ") SELECT fecha, racha_seca FROM ("
       + sg.streak_sql("d", "precip", b.D_DRY_THRESHOLD, "", "fecha") + ") s")
def q_streak_single_series(spark, sf_dir):
    """WIN4 on one global series: per-chunk streaks plus a carry table."""
    d = fe.with_window_features(b.daily_lineitem(spark, sf_dir, keyed=False), D1_SPEC, {},
                                back=1, fwd=0, streaks=[("racha_seca", "precip", b.D_DRY_THRESHOLD)])
    return d.select("fecha", "racha_seca")


# ------------------------------ row features --------------------------------

@query("seasonal_features", f"WITH d AS ({sg.D_SQL}) SELECT series, fecha, "
       + ", ".join(_season_wmo()[:8])
       + f" FROM (SELECT *, {', '.join(sg.seasonal_sql('fecha'))} FROM d) x")
def q_seasonal(spark, sf_dir):
    """FN2/FN3/FN13 — cyclic month/day-of-year encodings, season flags."""
    d = b.daily_lineitem(spark, sf_dir).withColumns(fe.seasonal_columns("fecha"))
    return present(d.select("series", "fecha", *SEASON_DBL, *SEASON_INTS))


@query("wmo_onehot", "SELECT event_id, k, " + sg.wmo_case("k") + " AS wmo_group, "
       + ", ".join(sg.wmo_onehot_sql("k"))
       + " FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) e")
def q_wmo_onehot(spark, sf_dir):
    """FN4/FN5/UDF1 — WMO group (CASE cascade, no Python UDF) + fixed one-hot."""
    e = b.table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("double").alias("k"))
    return e.select("event_id", "k", fe.wmo_group(F.col("k")).alias("wmo_group"),
                    *[c.alias(n) for n, c in fe.wmo_onehot_columns("k").items()])


# ------------------------------ sources & rollups ----------------------------

H_AGG = {"value": ["mean", "min", "max", "std"], "k": ["mean", "max"]}
H_AGG_NAMES = ["value_mean", "value_min", "value_max", "value_std", "k_mean", "k_max"]


@query("hourly_to_daily", """
SELECT event_type, CAST(ts AS DATE) AS fecha,
       ROUND(CAST(AVG(value) AS DOUBLE) + sign(CAST(AVG(value) AS DOUBLE)) * 1e-09, 6) AS value_mean, ROUND(CAST(MIN(value) AS DOUBLE) + sign(CAST(MIN(value) AS DOUBLE)) * 1e-09, 6) AS value_min,
       ROUND(CAST(MAX(value) AS DOUBLE) + sign(CAST(MAX(value) AS DOUBLE)) * 1e-09, 6) AS value_max, ROUND(CAST(STDDEV_SAMP(value) AS DOUBLE) + sign(CAST(STDDEV_SAMP(value) AS DOUBLE)) * 1e-09, 6) AS value_std,
       ROUND(CAST(AVG(k) AS DOUBLE) + sign(CAST(AVG(k) AS DOUBLE)) * 1e-09, 6) AS k_mean, ROUND(CAST(MAX(k) AS DOUBLE) + sign(CAST(MAX(k) AS DOUBLE)) * 1e-09, 6) AS k_max
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) e
GROUP BY 1, 2
""")
def q_hourly_to_daily(spark, sf_dir):
    """AGG1/PRJ3/UDF2 — spec-driven day rollup per series (``{var}_{fn}``)."""
    h = b.hourly_events(spark, sf_dir)
    return present(aggregate_to_daily(h, {**H_AGG, "missing_var": ["mean"]}, time="ts",
                                      keys=["event_type"]))


def _events_hourly(spark, sf_dir):
    """Events → hourly readings per type (mean value, max code per hour)."""
    h = b.hourly_events(spark, sf_dir)
    return h.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(
        F.avg("value").alias("value"), F.max("k").alias("k"))


_DWH_SQL = """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
h AS (SELECT event_type, date_trunc('hour', ts) AS ts, AVG(value) AS value, MAX(k) AS k
      FROM e GROUP BY 1, 2),
r AS (SELECT event_type, CAST(ts AS DATE) AS fecha, AVG(value) AS value_mean, MIN(value) AS value_min,
             MAX(value) AS value_max, AVG(k) AS k_mean, MAX(k) AS k_max FROM h GROUP BY 1, 2),
d AS (SELECT event_type, CAST(ts AS DATE) AS fecha, COUNT(*) AS n_events, SUM(value) AS value_sum
      FROM e GROUP BY 1, 2)
SELECT d.event_type, d.fecha, d.n_events, ROUND(CAST(d.value_sum AS DOUBLE) + sign(CAST(d.value_sum AS DOUBLE)) * 1e-09, 6) AS value_sum,
       ROUND(CAST(value_mean AS DOUBLE) + sign(CAST(value_mean AS DOUBLE)) * 1e-09, 6) AS value_mean, ROUND(CAST(value_min AS DOUBLE) + sign(CAST(value_min AS DOUBLE)) * 1e-09, 6) AS value_min, ROUND(CAST(value_max AS DOUBLE) + sign(CAST(value_max AS DOUBLE)) * 1e-09, 6) AS value_max,
       ROUND(CAST(k_mean AS DOUBLE) + sign(CAST(k_mean AS DOUBLE)) * 1e-09, 6) AS k_mean, ROUND(CAST(k_max AS DOUBLE) + sign(CAST(k_max AS DOUBLE)) * 1e-09, 6) AS k_max
FROM d LEFT JOIN r ON d.event_type = r.event_type AND d.fecha = r.fecha
"""


def daily_with_hourly(spark, sf_dir):
    ev = b.hourly_events(spark, sf_dir)
    daily = ev.groupBy("event_type", F.to_date("ts").alias("fecha")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))
    roll = aggregate_to_daily(_events_hourly(spark, sf_dir),
                              {"value": ["mean", "min", "max"], "k": ["mean", "max"]},
                              time="ts", keys=["event_type"])
    return join_daily(daily, roll, ["event_type"])


@query("daily_with_hourly", _DWH_SQL)
def q_daily_with_hourly(spark, sf_dir):
    """SRC3/JOIN1 — daily rows ⟕ rollup of hourly readings."""
    return present(daily_with_hourly(spark, sf_dir))


# H rollup renamed onto the weather names the derived features look for.
H_AS_WEATHER = {"value_mean": "pressure_msl_mean", "value_min": "pressure_msl_min",
                "value_max": "pressure_msl_max", "k_mean": "relative_humidity_2m_mean",
                "k_max": "wind_direction_10m_mean"}
DERIVED = ["pressure_trend_24h", "pressure_trend_48h", "pressure_range", "wind_west_component",
           "wind_north_component", "rh_vpd_interaction"]


@query("derived_features", """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
h AS (SELECT event_type, date_trunc('hour', ts) AS ts, AVG(value) AS value, MAX(k) AS k FROM e GROUP BY 1, 2),
r AS (SELECT event_type, CAST(ts AS DATE) AS fecha, AVG(value) AS pm, MIN(value) AS pmin, MAX(value) AS pmax,
             AVG(k) AS rh, MAX(k) AS wd, COUNT(*) AS n_hours, STDDEV_SAMP(value) AS vpd FROM h GROUP BY 1, 2)
SELECT event_type, fecha,
  ROUND(CAST(pm - LAG(pm, 1) OVER (PARTITION BY event_type ORDER BY fecha) AS DOUBLE) + sign(CAST(pm - LAG(pm, 1) OVER (PARTITION BY event_type ORDER BY fecha) AS DOUBLE)) * 1e-09, 6) AS pressure_trend_24h,
  ROUND(CAST(pm - LAG(pm, 2) OVER (PARTITION BY event_type ORDER BY fecha) AS DOUBLE) + sign(CAST(pm - LAG(pm, 2) OVER (PARTITION BY event_type ORDER BY fecha) AS DOUBLE)) * 1e-09, 6) AS pressure_trend_48h,
  ROUND(CAST(pmax - pmin AS DOUBLE) + sign(CAST(pmax - pmin AS DOUBLE)) * 1e-09, 6) AS pressure_range,
  ROUND(CAST(-(n_hours / 4.0) * sin(radians(wd)) AS DOUBLE) + sign(CAST(-(n_hours / 4.0) * sin(radians(wd)) AS DOUBLE)) * 1e-09, 6) AS wind_west_component,
  ROUND(CAST(-(n_hours / 4.0) * cos(radians(wd)) AS DOUBLE) + sign(CAST(-(n_hours / 4.0) * cos(radians(wd)) AS DOUBLE)) * 1e-09, 6) AS wind_north_component,
  ROUND(CAST(rh * vpd AS DOUBLE) + sign(CAST(rh * vpd AS DOUBLE)) * 1e-09, 6) AS rh_vpd_interaction
FROM r
""")
def q_derived_features(spark, sf_dir):
    """PRJ6/WIN2/FN1 — pressure trends (window diffs), ranges, wind vector,
    humidity×VPD; each guarded by column presence (no temp columns here, so
    ``temp_range`` is skipped)."""
    roll = aggregate_to_daily(_events_hourly(spark, sf_dir),
                              {"value": ["mean", "min", "max", "std"], "k": ["mean", "max"],
                               "ts": ["count"]}, time="ts", keys=["event_type"])
    w = (roll.withColumnsRenamed(H_AS_WEATHER)
         .withColumnsRenamed({"value_std": "vapour_pressure_deficit_mean"})
         .withColumn("wind_speed_10m_mean", F.col("ts_count") / 4.0))
    d = fe.add_derived_features(w, SeriesSpec(keys=("event_type",), time="fecha"))
    return present(d.select("event_type", "fecha", *DERIVED))


@query("payload_to_rows", "SELECT event_type, ts, ROUND(CAST(value AS DOUBLE) + sign(CAST(value AS DOUBLE)) * 1e-09, 6) AS value FROM events")
def q_payload_to_rows(spark, sf_dir):
    """SRC2/PRJ2 — column-oriented payload (``{hourly: {time: [...], value: [...]}}``)
    back to typed rows. The payloads are cut from ``events`` in blocks of at most
    64 readings, so no payload grows with the data."""
    pl = payload.rows_to_payload(b.table(spark, sf_dir, "events"), keys=["event_type"],
                                 time="ts", values=["value"], block=64, grain="hourly",
                                 block_key="event_id")
    return present(payload.payload_to_rows(pl, grain="hourly", keys=["event_type"]))


@query("daily_payload_to_rows", f"SELECT series, fecha, precip FROM ({sg.D_SQL}) d")
def q_daily_payload_to_rows(spark, sf_dir):
    """SRC1/PRJ2 — daily payload (dates as ISO strings) back to rows; one
    payload per series and year (bounded by the calendar)."""
    d = b.daily_lineitem(spark, sf_dir)
    pl = payload.rows_to_payload(d, keys=["series"], time="fecha", values=["precip"],
                                 grain="daily", block_expr=F.year("fecha"))
    return present(payload.payload_to_rows(pl, grain="daily", keys=["series"]))


# ------------------------- filters, audits, profiles -------------------------

@query("clean_rows", f"SELECT * FROM ({_feature_sql()}) t WHERE "
       + " AND ".join(f"{sg.q(c)} IS NOT NULL" for c in
                      ["series", "fecha", "precip", "n_lines", "price_mean", "disc_max", "tax_min",
                       "weather_code", "n_lines_lag1", "racha_seca", "precip_t1"]
                      + [f"{c}_lag1" for c in D_DOUBLES] + ROLL_NAMES))
def q_clean_rows(spark, sf_dir):
    """FLT3 — drop every row with a NULL anywhere (after NaN → NULL)."""
    return present(_feature_table(spark, sf_dir).na.drop("any"))


_AUDIT_COLS = ["precip_lag1", "n_lines_lag1"] + ROLL_NAMES + ["precip_t1", "racha_seca", "wmo_desconocido"]


@query("null_audit", f"""
WITH t AS ({_feature_sql()}),
u AS (UNPIVOT (SELECT {', '.join(f'CAST(COUNT(*) - COUNT({sg.q(c)}) AS BIGINT) AS {sg.q(c)}' for c in _AUDIT_COLS)} FROM t)
      ON {', '.join(sg.q(c) for c in _AUDIT_COLS)} INTO NAME column_name VALUE n_null)
SELECT column_name, n_null FROM u WHERE n_null > 0
""")
def q_null_audit(spark, sf_dir):
    """FLT7 — NULL count per column in one pass, only columns with NULLs."""
    return profile.null_audit(_feature_table(spark, sf_dir), _AUDIT_COLS)


@query("season_filter", f"""
SELECT series, fecha, ROUND(CAST(precip AS DOUBLE) + sign(CAST(precip AS DOUBLE)) * 1e-09, 6) AS precip FROM ({sg.D_SQL}) d
WHERE month(fecha) BETWEEN 5 AND 9 AND fecha BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
""")
def q_season_filter(spark, sf_dir):
    """FLT5 + FLT1 — months 5..9 inside an inclusive date range (pushed down)."""
    d = b.daily_lineitem(spark, sf_dir)
    d = profile.date_range(d, "fecha", "1996-01-01", "2000-12-31")
    return present(profile.month_range(d, "fecha", 5, 9).select("series", "fecha", "precip"))


@query("year_counts", f"SELECT series, CAST(year(fecha) AS INTEGER) AS yr, COUNT(*) AS n FROM ({sg.D_SQL}) d GROUP BY 1, 2")
def q_year_counts(spark, sf_dir):
    """AGG2 — rows per year."""
    d = b.daily_lineitem(spark, sf_dir)
    return d.groupBy("series", F.year("fecha").alias("yr")).agg(F.count(F.lit(1)).alias("n"))


@query("target_describe", f"""
SELECT series, COUNT(precip) AS n, {rnd('AVG(precip)')} AS mean, {rnd('STDDEV_SAMP(precip)')} AS std,
       {rnd('MIN(precip)')} AS min, {rnd('quantile_cont(precip, 0.25)')} AS q25,
       {rnd('quantile_cont(precip, 0.5)')} AS q50, {rnd('quantile_cont(precip, 0.75)')} AS q75,
       {rnd('MAX(precip)')} AS max
FROM ({sg.D_SQL}) d GROUP BY 1
""")
def q_target_describe(spark, sf_dir):
    """AGG3 — describe() of the target: count/mean/std/min/quartiles/max."""
    return present(profile.describe(b.daily_lineitem(spark, sf_dir), "precip", ["series"]))


@query("class_balance", f"""
SELECT series, COUNT(*) FILTER (WHERE precip > {b.D_DRY_THRESHOLD}) AS n_wet,
       COUNT(*) FILTER (WHERE NOT (precip > {b.D_DRY_THRESHOLD})) AS n_dry,
       COUNT(*) FILTER (WHERE precip > 250.0) AS n_peak,
       {rnd(f'AVG(CAST(precip > {b.D_DRY_THRESHOLD} AS INTEGER))')} AS wet_share,
       {rnd(f'CAST(COUNT(*) FILTER (WHERE NOT (precip > {b.D_DRY_THRESHOLD})) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE precip > {b.D_DRY_THRESHOLD}), 0)')} AS class_weight
FROM ({sg.D_SQL}) d GROUP BY 1
""")
def q_class_balance(spark, sf_dir):
    """AGG15 — wet/dry/peak counts, wet share and the n_neg/n_pos weight."""
    return present(profile.class_balance(b.daily_lineitem(spark, sf_dir), "precip",
                                         b.D_DRY_THRESHOLD, 250.0, ["series"]))


@query("period_extent", f"""
SELECT series, CAST(year(fecha) AS INTEGER) AS yr, MIN(fecha) AS start, MAX(fecha) AS "end", COUNT(*) AS n
FROM ({sg.D_SQL}) d GROUP BY 1, 2
""")
def q_period_extent(spark, sf_dir):
    """AGG16 — first/last date and row count per slice."""
    d = b.daily_lineitem(spark, sf_dir).withColumn("yr", F.year("fecha"))
    return profile.extent(d, "fecha", ["series", "yr"])


# ------------------- the reference's default pipeline, whole -------------------

def weather_features(spark, sf_dir):
    """SRC3 → AGG1 (reference hourly spec) → JOIN1 → PRJ1 rename → PRJ6
    derived (incl. ``temp_range``) → ML17 with the default configuration
    (33 lags, 90 rolling columns, streak, seasonality, WMO one-hot, target)."""
    from pluvio.operators.rollup import HOURLY_AGGREGATIONS
    tune_optimizer(spark)
    spec = SeriesSpec(keys=("series",), time="fecha")
    roll = aggregate_to_daily(b.weather_hourly(spark, sf_dir), HOURLY_AGGREGATIONS, time="ts", keys=["series"])
    joined = join_daily(b.weather_daily(spark, sf_dir), roll, ["series"])
    renamed = fe.prepare(joined, spec, fe.RENAME_MAP)
    derived = fe.add_derived_features(renamed, spec)
    return fe.build_features(derived, spec, fe.FeatureConfig())


def _weather_sql():
    from pluvio.operators.rollup import HOURLY_AGGREGATIONS
    fn = {"mean": "AVG", "min": "MIN", "max": "MAX"}
    roll_cols = [f"{v}_{f}" for v, fs in HOURLY_AGGREGATIONS.items() for f in fs]
    w = "OVER (PARTITION BY series ORDER BY fecha)"
    daily = ", ".join(f"{sq} AS {n}" for n, _, sq in b.WEATHER_DAILY)
    hourly = ", ".join(f"{sq} AS {n}" for n, _, sq in b.WEATHER_HOURLY)
    roll = ", ".join(f"{fn[f]}({v}) AS {v}_{f}" for v, fs in HOURLY_AGGREGATIONS.items() for f in fs)
    ren = ", ".join(f"{k} AS {v}" for k, v in fe.RENAME_MAP.items())
    derived_names = ["pressure_trend_24h", "pressure_trend_48h", "pressure_range", "temp_range",
                     "wind_west_component", "wind_north_component", "rh_vpd_interaction"]
    der = (f"pressure_msl_mean - LAG(pressure_msl_mean, 1) {w} AS pressure_trend_24h, "
           f"pressure_msl_mean - LAG(pressure_msl_mean, 2) {w} AS pressure_trend_48h, "
           "pressure_msl_max - pressure_msl_min AS pressure_range, temp_max - temp_min AS temp_range, "
           "-wind_speed_10m_mean * sin(radians(wind_direction_10m_mean)) AS wind_west_component, "
           "-wind_speed_10m_mean * cos(radians(wind_direction_10m_mean)) AS wind_north_component, "
           "relative_humidity_2m_mean * vapour_pressure_deficit_mean AS rh_vpd_interaction")
    lags = sg.lag_sql(fe.LAG_VARS, "series", "fecha")
    rolls = sg.rolling_sql(fe.ROLLING_VARS, "series", "fecha")
    inner = f"SELECT *, {', '.join(lags + rolls)}, LEAD(precip, 1) {w} AS precip_t1 FROM der"
    streak = sg.streak_sql(f"({inner})", "precip", fe.STREAK_THRESHOLD, "series", "fecha")
    roll_names = [f"{c}_{t}_{k}" for c in fe.ROLLING_VARS for k in fe.ROLLING_WINDOWS for t in ("rmean", "rstd", "rmax")]
    dbl = (list(fe.RENAME_MAP.values()) + roll_cols + derived_names + [f"{c}_lag1" for c in fe.LAG_VARS]
           + roll_names + ["precip_t1"])
    return f"""
WITH daily AS (SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS fecha, {daily} FROM lineitem GROUP BY 1, 2),
hourly AS (SELECT l_returnflag AS series, l_shipdate + to_hours(l_linenumber) AS ts, {hourly} FROM lineitem),
roll AS (SELECT series, CAST(ts AS DATE) AS fecha, {roll} FROM hourly GROUP BY 1, 2),
j AS (SELECT d.*, {', '.join('r.' + c for c in roll_cols)} FROM daily d LEFT JOIN roll r USING (series, fecha)),
ren AS (SELECT series, fecha, {ren}, {', '.join(roll_cols)} FROM j),
der AS (SELECT *, {der} FROM ren),
f AS ({streak})
SELECT series, fecha, racha_seca, {sg.round_cols(dbl)}, {', '.join(_season_wmo())}
FROM (SELECT *, {', '.join(sg.seasonal_sql('fecha'))} FROM f) g
"""


@query("weather_feature_table", _weather_sql())
def q_weather_feature_table(spark, sf_dir):
    """The reference's default pipeline end to end on weather-shaped inputs
    (every configured daily and hourly variable present): ~180 columns."""
    return present(weather_features(spark, sf_dir))
