"""Governed data products on Spark: ingest, transform, govern, publish, register."""

__version__ = "0.1.0"
