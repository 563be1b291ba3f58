"""Structured Streaming form of the event load: incremental, exactly-once ingest of CSV drops."""
