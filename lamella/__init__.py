"""lamella: a Spark-native engine that turns raw document collections into curated text."""

__version__ = "0.1.0"
