"""Spark-native measurement analytics: sheets to long series, quality rules, bins and serving tables."""
