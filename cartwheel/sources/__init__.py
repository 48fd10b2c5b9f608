"""Readers: driver tables, app-log text, change records, JDBC queries."""
