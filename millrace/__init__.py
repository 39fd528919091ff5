"""millrace: a Spark-native engine for ingesting, checking and refining tables and texts."""

__version__ = "0.1.0"
