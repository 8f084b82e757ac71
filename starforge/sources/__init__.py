"""Sources and sinks: the Bronze file catalog, format readers, Parquet sinks."""
