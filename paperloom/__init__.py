"""paperloom: a PySpark-native engine for corpora of scholarly documents."""

__version__ = "0.1.0"
