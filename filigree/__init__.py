"""Spark operators and ready jobs for sentence-level filing corpora."""
