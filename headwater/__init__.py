"""Headwater: a Spark-first engine for monitoring headlines."""
