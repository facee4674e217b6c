"""Layered-analytics operators on the Spark DataFrame API."""
