"""Spark-native lakehouse and analytics engine."""
