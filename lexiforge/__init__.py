"""Lexiforge: a Spark-native engine for text corpora and subword tokenizers."""

__version__ = "0.1.0"
