"""panelspark: a PySpark-native library for repeated (panel) microdata.

Every operator is a function from DataFrame(s) to DataFrame, built on Spark SQL
expressions and MLlib, so Catalyst plans it and executors run it.  Nothing is
collected inside an operator except bounded metadata (fitted model parameters,
k centroids, category labels).
"""

from panelspark.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
