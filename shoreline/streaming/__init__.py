"""Structured Streaming: topic sources, raw-layer ingest, streaming dedup."""
