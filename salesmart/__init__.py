"""Spark-native sales-mart engine.

Report templates run as DataFrame aggregations, raw report rows are
normalised and coerced with built-in expressions, money measures are
converted to the base currency through an as-of rate join, and the mart
is maintained by idempotent range replacement over a month/source
partitioned Parquet table.
"""

from salesmart.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
