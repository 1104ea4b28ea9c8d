"""Composed plans: record transform, analytics views, data quality, run metrics, whole runs."""
