"""Sources: landing NDJSON objects (candles, news) with their file metadata, and the
exchange screener CSV files. Every reader declares its schema (no inference)."""
