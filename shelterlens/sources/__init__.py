"""Sources (parquet, JDBC, CSV exports), the resolved shelter model, and sinks."""
