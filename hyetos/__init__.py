"""Forecast and alert analytics expressed as Spark DataFrame transformations."""
