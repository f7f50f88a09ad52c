"""Spark-native cohort analytics: metadata, matrices, correlation networks and control-plane reports."""
