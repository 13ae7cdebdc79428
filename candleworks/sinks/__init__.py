"""Sinks: warehouse tables (by-name, re-runnable writes) and NDJSON/CSV landing drops."""
