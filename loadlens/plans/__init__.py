"""Registered queries (catalog), their DuckDB oracles, result comparison, and SQL views."""
