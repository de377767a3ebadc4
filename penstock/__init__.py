"""Spark-native operators for device streams, application logs and lake-table upkeep."""
