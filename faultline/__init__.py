"""Faultline: incident analytics expressed as Spark DataFrame transformations."""

__version__ = "0.1.0"
