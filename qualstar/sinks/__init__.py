"""Sinks: partitioned parquet layers, tables, small CSV results, history."""
