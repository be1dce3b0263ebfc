"""Structured Streaming ingestion of newly arrived objects."""
