"""tessera: Spark-native operators for tabular ML data work.

Every operator takes DataFrames (with an explicit row key where rows must be
matched) and returns DataFrames.  Work runs as Spark SQL expressions, joins,
aggregations and ``pyspark.ml`` stages; only fitted parameters of bounded size
ever reach the driver.
"""

__version__ = "0.1.0"
