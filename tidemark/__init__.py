"""Change-data capture and row mapping on Spark."""

__version__ = "0.2.0"
