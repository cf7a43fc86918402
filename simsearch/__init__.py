"""Similarity search and retrieval evaluation over labelled text, as Spark jobs."""
