"""Basket analytics as Spark DataFrame jobs."""
