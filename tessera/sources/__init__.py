"""Sources and sinks: parquet tables, delimited files, JSON, whole texts, upserts."""
