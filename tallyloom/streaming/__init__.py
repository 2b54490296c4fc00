"""Streaming ingest, an extension: files that arrive are appended to the raw table once each."""
