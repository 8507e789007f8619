"""Skein: a Spark-native engine for curating asset and text corpora."""
