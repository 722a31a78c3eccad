"""Readers for the driver's Parquet tables."""
