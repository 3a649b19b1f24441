"""Writers: hour-partitioned Parquet, keyed upsert on Parquet, JDBC stage/append."""
