"""fieldloom - a Spark-native engine for event feeds, district panels and text corpora."""

__version__ = "0.1.0"
