"""Spark-native building blocks for machine-learning data work."""
