"""Screenloom: a Spark-native engine for screening bibliographic records."""

__version__ = "0.1.0"
