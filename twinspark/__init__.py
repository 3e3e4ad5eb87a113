"""Spark-native similarity, entity-resolution and corpus analytics."""
