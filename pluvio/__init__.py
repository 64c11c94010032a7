"""pluvio — keyed time-series forecasting and monitoring operators on Spark.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the heavy
lifting (rollups, windows, joins, metrics) is expressed with the DataFrame
API so Catalyst plans it and the work stays distributed.
"""

from pluvio.series import SeriesSpec, nan_to_null

__all__ = ["SeriesSpec", "nan_to_null"]
__version__ = "0.1.0"
