"""Spark-native sales analytics: validation, enrichment, marts, views, anomalies."""
