"""Small helpers that write the DuckDB oracle SQL for the window features.

The oracle is plain ANSI window SQL over the driver's views; it shares only
the parameter lists (variables, windows, thresholds) with the Spark side.
"""

from __future__ import annotations

from pluvio.plans.registry import rnd

D_SQL = """
SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS fecha,
       SUM(l_quantity) AS precip,
       COUNT(l_orderkey) AS n_lines,
       AVG(l_extendedprice) AS price_mean,
       MAX(l_discount) AS disc_max,
       MIN(l_tax) AS tax_min,
       CAST(CAST(SUM(l_quantity) AS BIGINT) % 100 AS DOUBLE) AS weather_code
FROM lineitem GROUP BY 1, 2
"""

D1_SQL = """
SELECT CAST(l_shipdate AS DATE) AS fecha,
       SUM(l_quantity) AS precip,
       COUNT(l_orderkey) AS n_lines,
       AVG(l_extendedprice) AS price_mean,
       MAX(l_discount) AS disc_max,
       MIN(l_tax) AS tax_min,
       CAST(CAST(SUM(l_quantity) AS BIGINT) % 100 AS DOUBLE) AS weather_code
FROM lineitem GROUP BY 1
"""


def over(part: str, order: str, frame: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"OVER ({p}ORDER BY {order} {frame})"


def lag_sql(cols, part, order, lags=(1,)):
    return [f"LAG({c}, {n}) {over(part, order)} AS {c}_lag{n}" for c in cols for n in lags]


_FN = {"mean": ("rmean", "AVG"), "std": ("rstd", "STDDEV_SAMP"), "max": ("rmax", "MAX"),
       "min": ("rmin", "MIN"), "sum": ("rsum", "SUM")}


def rolling_sql(cols, part, order, windows=(7, 14, 30), stats=("mean", "std", "max")):
    out = []
    for c in cols:
        for w in windows:
            fr = f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING"
            for s in stats:
                tag, fn = _FN[s]
                out.append(f"CASE WHEN COUNT({c}) {over(part, order, fr)} = {w} "
                           f"THEN {fn}({c}) {over(part, order, fr)} END AS {c}_{tag}_{w}")
    return out


def streak_sql(src: str, col: str, thr: float, part: str, order: str, name: str = "racha_seca",
               select: str = "*") -> str:
    """Dry streak as gaps-and-islands: position minus last 'wet' position."""
    return f"""
SELECT {select}, CAST(_rn - MAX(CASE WHEN _wet THEN _rn END)
        {over(part, order, 'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')} AS INTEGER) AS {name}
FROM (SELECT *, ROW_NUMBER() {over(part, order)} AS _rn,
             NOT COALESCE(LAG({col}) {over(part, order)} <= {thr}, FALSE) AS _wet
      FROM {src}) _s
"""


def seasonal_sql(t: str) -> list[str]:
    m, doy = f"month({t})", f"dayofyear({t})"
    return [f"sin(2 * pi() * {m} / 12) AS mes_sin", f"cos(2 * pi() * {m} / 12) AS mes_cos",
            f"sin(2 * pi() * {doy} / 365) AS \"dia_año_sin\"", f"cos(2 * pi() * {doy} / 365) AS \"dia_año_cos\"",
            f"CAST({m} IN (12, 1, 2) AS INTEGER) AS estacion_verano",
            f"CAST({m} IN (3, 4, 5) AS INTEGER) AS \"estacion_otoño\"",
            f"CAST({m} IN (6, 7, 8) AS INTEGER) AS estacion_invierno",
            f"CAST({m} IN (9, 10, 11) AS INTEGER) AS estacion_primavera"]


def wmo_case(x: str) -> str:
    t = f"CAST(trunc({x}) AS INTEGER)"
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'desconocido' WHEN {t} <= 1 THEN 'despejado' "
            f"WHEN {t} <= 3 THEN 'nublado' WHEN {t} <= 48 THEN 'niebla' WHEN {t} <= 67 THEN 'lluvia_leve' "
            f"WHEN {t} <= 77 THEN 'nieve' ELSE 'tormenta' END")


def wmo_onehot_sql(x: str) -> list[str]:
    cats = ["despejado", "nublado", "niebla", "lluvia_leve", "nieve", "tormenta", "desconocido"]
    return [f"CAST(({wmo_case(x)}) = '{c}' AS INTEGER) AS wmo_{c}" for c in cats]


def round_cols(names: list[str]) -> str:
    return ", ".join(f"{rnd(q(n))} AS {q(n)}" for n in names)


def q(n: str) -> str:
    return f'"{n}"'
