"""Readers (parquet tables, delimited and JSON files, typed graph files) and writers."""
