"""Table sources and sinks: parquet folders, JDBC tables, text files."""
