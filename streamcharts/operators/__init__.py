"""DataFrame operators: intake, rollups, trending, catalog, privacy, observability."""
