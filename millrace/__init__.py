"""Millrace: a PySpark-native engine for building and inspecting text corpora."""
