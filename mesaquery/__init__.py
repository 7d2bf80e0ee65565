"""Spark-native analytics over programme-style catalogues."""
