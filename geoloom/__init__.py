"""Spark-native engine for geospatial collection planning."""
