"""Named queries over the driver tables and their DuckDB oracle SQL."""

import importlib

_MODULES = ["q_features", "q_splits", "q_metrics", "q_monitor", "q_runs", "q_functions", "q_models", "q_streaming"]


def load_all():
    for m in _MODULES:
        importlib.import_module(f"pluvio.plans.{m}")
    from pluvio.plans.registry import ORACLE, QUERIES
    return QUERIES, ORACLE
