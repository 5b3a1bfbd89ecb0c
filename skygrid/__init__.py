"""Gridded weather observations and rain forecasts as Spark jobs."""

__version__ = "0.1.0"
