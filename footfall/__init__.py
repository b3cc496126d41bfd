"""Behaviour analytics for e-commerce logs, written as PySpark DataFrame jobs."""
