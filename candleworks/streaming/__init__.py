"""Incremental ingest of landing drops with Structured Streaming (file source,
``foreachBatch`` into the repeatable warehouse jobs)."""
