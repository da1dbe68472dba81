"""Spark-native engine for clinical data quality, harmonisation and multi-site statistics."""
