"""Composite jobs (ingest, feature model, training, scoring) and the query catalog."""
