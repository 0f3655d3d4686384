"""Spark-native text corpus processing and operational analytics."""
