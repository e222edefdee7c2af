"""Jobs: ingest, curate, metrics, serve, train."""
