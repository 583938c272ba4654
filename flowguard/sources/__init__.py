"""Sources and sinks: flow CSV ingestion, Parquet stage tables, schema contracts."""
