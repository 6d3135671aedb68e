"""Lodestone: a Spark-native knowledge-base analytics engine."""
