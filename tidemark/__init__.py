"""Spark-native growth analytics: events in, sessions, attribution, dimensions and daily marts out."""
