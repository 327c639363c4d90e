"""Incremental ingestion."""
