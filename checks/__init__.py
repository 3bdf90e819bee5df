"""Registered queries, their DuckDB counterparts and the comparison of both."""
