"""Spark-native incremental medallion tables and large-corpus text operators."""
