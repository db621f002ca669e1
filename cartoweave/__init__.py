"""Thematic vector-map layers at country to planet scale, as Spark DataFrame jobs."""

__version__ = "0.1.0"
