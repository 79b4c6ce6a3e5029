"""Spark operators for linking two catalogues by name and searching feature vectors."""
