"""Layered-table operators for PySpark: raw -> clean -> curated -> mart."""
