"""Continuous ingest of raw logs."""
