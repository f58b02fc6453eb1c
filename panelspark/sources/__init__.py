"""Sources and sinks: manifest, by-name scans, Parquet datasets, models."""
