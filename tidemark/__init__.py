"""Spark-native ingest and analysis of revenue events."""
