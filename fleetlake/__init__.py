"""fleetlake: bus-fleet position analytics expressed as Spark DataFrame plans.

Layers (each a set of lazy ``DataFrame -> DataFrame`` functions):

* ``sources``   – bronze JSON, silver/gold Parquet, JDBC readers, test-table mapping
* ``functions`` – column expressions (hour addressing, text -> timestamp, zone shift)
* ``operators`` – flatten, fleet statistics, target checks, key checks, merge
* ``sinks``     – hour-partitioned Parquet writes, keyed upsert, JDBC stage/append
* ``plans``     – the batch jobs and the dashboard queries built from the above
* ``streaming`` – Structured Streaming forms of the recompute and rollup jobs
"""

__version__ = "0.1.0"
