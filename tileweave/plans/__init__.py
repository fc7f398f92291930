"""Registered queries, each with its DuckDB counterpart where SQL has one."""
