"""Warehouse loading on Spark: dimensions, facts, data quality and archives."""
