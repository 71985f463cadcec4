"""tidemark: market-sentiment analytics as plain Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, windows, joins, Structured Streaming or Spark ML.
"""

from tidemark.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
