"""airmart: a Spark-native air-quality mart.

Landing JSON -> raw table (VARIANT) -> clean (latest file wins) -> hourly
consumption layer -> star schema -> serving views, dashboard queries and
data-quality checks, each a DataFrame -> DataFrame function on Spark SQL
expressions.

Subpackages: ``functions`` (column expressions), ``sources`` (landing files
and the reading adapter), ``operators`` (the layers, views, dashboards and
checks), ``plans`` (join strategy, materialization, query registry, SQL
surface, DuckDB oracle) and ``streaming`` (incremental refresh).
"""

__version__ = "0.1.0"
