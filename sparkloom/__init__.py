"""Spark-native media-record processing engine."""
