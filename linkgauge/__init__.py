"""Spark-native URL scoring, domain reputation and page analysis."""
