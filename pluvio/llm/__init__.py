"""Operators for preparing language-model training data.

One module per operator (``op01_...`` to ``op10_...``), their named queries
and DuckDB twins in ``queries``. Nothing outside this subpackage imports it.
"""
