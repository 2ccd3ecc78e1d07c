"""Featherline: a PySpark-native analytics engine for feature datasets."""
