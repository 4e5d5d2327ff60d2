"""Registered queries (Spark side and DuckDB oracle)."""
