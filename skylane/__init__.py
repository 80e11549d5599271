"""skylane — arrival-performance analytics for terminal areas, built on Spark.

Every public function maps DataFrames (plus an :class:`ArrivalRules`) to a
DataFrame.  Work is expressed with built-in Spark SQL expressions so Catalyst
can push filters into the Parquet scan, prune columns and plan the joins.
"""

from skylane.config import ArrivalRules

__all__ = ["ArrivalRules"]
