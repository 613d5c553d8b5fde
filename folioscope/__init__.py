"""Document ingestion and retrieval on Spark DataFrames."""
