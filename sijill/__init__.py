"""Sijill: document intelligence as PySpark DataFrame transformations."""
