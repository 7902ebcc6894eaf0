"""Retail, rental and transit analytics as PySpark DataFrame jobs."""
