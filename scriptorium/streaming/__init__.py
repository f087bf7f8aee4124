"""Streaming ingest, an extension: the batch operators over files as they arrive."""
