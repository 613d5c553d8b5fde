"""Readers: document files, command logs and tables."""
