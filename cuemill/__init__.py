"""cuemill: a PySpark-native engine for timed-text corpora and their registry."""

__version__ = "0.1.0"
