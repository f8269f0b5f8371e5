"""Queries on the driver tables that call the library, each with an equal DuckDB statement."""
