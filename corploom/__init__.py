"""Corpus work for languages with few resources, as PySpark DataFrame jobs."""

__version__ = "0.1.0"
