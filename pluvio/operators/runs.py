"""Experiment runs table (SNK5, SRC6, FN16-18, JOIN6, ML16, PRJ11, SET4).

A run is one row: ``run_id, parent_run_id, run_name, tags map<string,string>,
params map<string,string>, metrics map<string,double>``. Searching, typing
and ranking runs are plain DataFrame operations on that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("parent_run_id", T.StringType(), True),
    T.StructField("run_name", T.StringType(), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
])
# Keys that describe the evaluation, not the model (dropped before refitting).
NO_MODEL_KEYS = ["threshold", "log_target", "clf_rain_threshold", "reg_rain_threshold", "n_splits"]


def to_param_map(*pairs: tuple[str, Column]) -> Column:
    """SNK5 — params as strings, NULL values dropped."""
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def to_metric_map(*pairs: tuple[str, Column], prefix: str = "") -> Column:
    """SNK5 — metrics as doubles, only non-NULL ones, optional key prefix
    (``cv_avg_``, ``test_``, ``baseline_`` …)."""
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("double"))])
    m = F.map_filter(m, lambda k, v: v.isNotNull() & ~F.isnan(v))
    return F.transform_keys(m, lambda k, v: F.concat(F.lit(prefix), k)) if prefix else m


def cv_runs(fold_metrics: DataFrame, fold_col: str, metrics: list[str], run_name: str,
            tags: dict[str, str] | None = None, params: dict | None = None) -> DataFrame:
    """SNK5 — rows for the runs table: one parent with the average metrics
    (keys prefixed ``cv_avg_``) and one child per fold."""
    def of(d: DataFrame, run_id: Column, parent: Column, prefix: str) -> DataFrame:
        text = lambda m: F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(str(v)))]) if m else F.create_map().cast("map<string,string>")
        return d.select(run_id.alias("run_id"), parent.cast("string").alias("parent_run_id"), F.lit(run_name).alias("run_name"),
                        text(tags).alias("tags"), text(params).alias("params"),
                        to_metric_map(*[(m, F.col(m)) for m in metrics], prefix=prefix).alias("metrics"))
    children = of(fold_metrics, F.concat(F.lit(f"{run_name}-"), F.col(fold_col).cast("string")), F.lit(f"{run_name}-parent"), "")
    parent = of(fold_metrics.agg(*[F.avg(m).alias(m) for m in metrics]), F.lit(f"{run_name}-parent"), F.lit(None), "cv_avg_")
    return children.unionByName(parent)


def append_runs(rows: DataFrame, path: str) -> None:
    """SNK5 — append to the runs table; an append never rewrites older runs."""
    rows.select(*RUNS_SCHEMA.fieldNames()).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def search(runs: DataFrame, tags: dict[str, str] | None = None, order_metric: str | None = None,
           ascending: bool = True) -> DataFrame:
    """SRC6 — runs whose tags equal the given values, ordered by a metric
    (NULLs last)."""
    out = runs
    for k, v in (tags or {}).items():
        out = out.filter(F.col("tags")[k] == F.lit(v))
    if order_metric:
        m = F.col("metrics")[order_metric]
        out = out.orderBy(m.asc_nulls_last() if ascending else m.desc_nulls_last(), F.col("run_name"))
    return out


def typed_param(v: Column) -> Column:
    """FN16 — string param → struct(kind, bool, int, float, string):
    NULL → NULL; 'true'/'false' (any case, trimmed) → bool; digits only (no
    '.') → int; parses as a number → float; otherwise the trimmed string. An
    integer beyond 64 bits keeps its digits in the string field."""
    t = F.trim(v)
    low = F.lower(t)
    is_bool = low.isin("true", "false")
    is_int = ~t.contains(".") & t.rlike(r"^[+-]?[0-9]+$")
    as_float = F.when(t.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"),
                      t.try_cast("double"))
    kind = (F.when(v.isNull(), None).when(is_bool, "bool").when(is_int, "int")
            .when(as_float.isNotNull(), "float").otherwise("string"))
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "bool", low == "true").alias("bool_value"),
        F.when(kind == "int", t.try_cast("long")).alias("int_value"),
        F.when(kind == "float", as_float).alias("float_value"),
        F.when((kind == "string") | (kind == "int") & t.try_cast("long").isNull(), t).alias("str_value"))


def typed_params(runs: DataFrame) -> DataFrame:
    """FN16 over every (run, key): explode the params map and type each value."""
    e = runs.select("run_id", F.explode("params").alias("key", "value"))
    return e.select("run_id", "key", typed_param(F.col("value")).alias("t")).select("run_id", "key", "t.*")


def strip_prefix(params: Column, prefix: str) -> Column:
    """FN17 — keep keys starting with ``prefix`` and drop the prefix."""
    kept = F.map_filter(params, lambda k, v: k.startswith(prefix))
    return F.transform_keys(kept, lambda k, v: F.substr(k, F.lit(len(prefix) + 1)))


def drop_keys(params: Column, keys: list[str] = NO_MODEL_KEYS) -> Column:
    """FN18 — remove evaluation-only keys."""
    return F.map_filter(params, lambda k, v: ~F.array_contains(F.array(*[F.lit(x) for x in keys]), k))


def merge_maps(left: Column, right: Column) -> Column:
    """SET4 — dict merge where the right side wins on duplicate keys
    (``map_concat`` + ``map_from_entries`` keeping the last entry per key)."""
    entries = F.concat(F.map_entries(left), F.map_entries(right))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.transform(keys, lambda k: F.element_at(
        F.filter(entries, lambda e: e["key"] == k), -1))
    return F.map_from_entries(last)


def flatten_params(df: DataFrame, params_col: str, keys: list[str], prefix: str = "params_") -> DataFrame:
    """PRJ11 — chosen map keys as ``params_<key>`` columns."""
    return df.withColumns({f"{prefix}{k}": F.col(params_col)[k] for k in keys})


def best_per_group(runs: DataFrame, group: Column, metric: str, ascending: bool = True) -> DataFrame:
    """ML16/ORD4 — top-1 run per group by a metric, NULLs last, run name
    then run id breaking ties; a grouped ``min_by`` (no sort of the runs table)."""
    m = F.col("metrics")[metric]
    key = F.struct(m.isNull().alias("n"), (m if ascending else -m).alias("m"), F.col("run_name").alias("r"),
                   F.col("run_id").alias("i"))
    g = runs.withColumn("_grp", group).groupBy("_grp").agg(
        F.min_by(F.struct("run_id", "run_name", m.alias(metric)), key).alias("_b"))
    return g.select(F.col("_grp").alias("group"), "_b.*")
