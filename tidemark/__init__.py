"""Spark-native table synchronisation and reconciliation engine."""
