"""Scans: files, archives, listings, tables and encrypted chunks."""
