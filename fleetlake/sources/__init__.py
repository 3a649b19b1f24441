"""Readers: bronze JSON landing, silver/gold Parquet lake, JDBC, test-table mapping."""
