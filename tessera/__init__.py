"""Spark-native analytics for droplet single-cell targeted sequencing."""

__version__ = "0.2.0"
