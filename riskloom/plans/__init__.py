"""The four flows: ingest, exploration, training, report."""
