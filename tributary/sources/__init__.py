"""Readers and writers: CSV, Parquet, relational tables, paged JSON."""
