"""Registered queries, their parameters and the DuckDB oracle SQL."""
