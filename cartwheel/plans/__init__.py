"""Named plans over the driver tables: ``catalog`` (Spark) and ``oracle`` (DuckDB SQL)."""
