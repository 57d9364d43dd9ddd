"""Spark-native bar algebra, data-quality rules and lake lifecycle for trade and quote events."""
