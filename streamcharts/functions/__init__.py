"""Column-level helpers: pseudonym, time, limits, roles, text formats."""
