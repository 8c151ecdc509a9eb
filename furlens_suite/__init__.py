"""Registered queries over the driver tables, each with its DuckDB counterpart where SQL can express it."""
