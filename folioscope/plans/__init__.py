"""Operators assembled into jobs, and the registered queries with their SQL."""
