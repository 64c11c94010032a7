"""Driver contract and plan checks."""

import __spark_entry__ as E
from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "racha_seca" in df.columns and "precip_t1" in df.columns


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 70


def test_feature_table_one_exchange_for_all_windows(spark):
    """All lag/rolling/streak/target windows share one hash exchange by series."""
    from pluvio.plans import q_features as qf
    plan = qf._feature_table(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    exchanges = [ln for ln in lines if "Exchange hashpartitioning" in ln]
    # one for the daily aggregate (series, day), one shared by every window (series)
    assert len(exchanges) == 2
    assert sum("Sort [series" in ln for ln in lines) == 1


def test_scan_prunes_columns(spark):
    from pluvio.plans import bindings as b
    plan = b.daily_lineitem(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" not in plan and "l_linestatus" not in plan


def test_entry_module_imports_without_spark():
    """The driver may list queries/oracles before any session exists."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql(); "
            "from pyspark.sql import SparkSession; assert SparkSession.getActiveSession() is None; "
            "print(len(q), len(o))")
    r = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert r.returncode == 0, r.stderr[-2000:]
