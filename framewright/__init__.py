"""Temporal-interval analytics over shot-structured media, as PySpark DataFrame plans."""
