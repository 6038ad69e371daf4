"""Spark-native analytics over archives of ranked tables."""
