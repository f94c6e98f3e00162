"""Readers: stored Parquet tables, landed JSON payloads, derived fixtures."""
