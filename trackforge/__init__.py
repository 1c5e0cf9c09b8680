"""Spark-native resolution of messy track metadata into canonical records."""
