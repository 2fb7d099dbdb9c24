"""Palimpsest: a PySpark-native engine for building and auditing rewritten text corpora."""

__version__ = "0.1.0"
