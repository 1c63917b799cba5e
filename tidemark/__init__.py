"""Tidemark: Spark-native market analytics on DataFrames."""

__version__ = "0.1.0"
