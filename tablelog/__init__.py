"""Spark-native tables over Parquet files and an ordered transaction log."""
