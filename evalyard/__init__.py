"""Spark-native evaluation analytics: parse, grade and score model outputs as DataFrames."""

__version__ = "0.1.0"
