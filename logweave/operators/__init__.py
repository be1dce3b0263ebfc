"""Row operators: records, projection, timeline rows, routing, chunks."""
