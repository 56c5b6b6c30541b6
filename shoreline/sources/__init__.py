"""Scans and sinks: partitioned lake tables, batch drops, streams, serving tables."""
