"""Readers and writers for CSV, parquet, JSON, text and fitted models."""
