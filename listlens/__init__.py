"""Spark-native feature building, profiling and classification of marketplace listings."""
