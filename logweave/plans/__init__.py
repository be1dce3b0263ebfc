"""Whole jobs: network and timeline ingestion, correlation queries, sinks."""
