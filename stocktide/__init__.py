"""Retail demand analytics as Spark DataFrame jobs."""
