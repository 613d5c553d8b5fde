"""Ingestion on arrival and its monitoring."""
