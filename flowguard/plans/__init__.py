"""Query plans over the driver tables: derived fixtures, the query catalog and
the DuckDB oracle SQL that checks it."""
