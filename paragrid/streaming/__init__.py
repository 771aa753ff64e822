"""Resumable windowed ingest as a streaming source, with idempotent sinks."""
