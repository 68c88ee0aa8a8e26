"""Spatial building analytics expressed as Spark DataFrame jobs."""
