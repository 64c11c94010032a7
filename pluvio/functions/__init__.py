"""Scalar column functions (FN1-FN24). All are built-in Spark expressions —
they stay inside whole-stage codegen; none needs a Python UDF."""

from pluvio.functions.scalar import *  # noqa: F401,F403
