"""Advertising-report analytics as PySpark DataFrame transforms."""
