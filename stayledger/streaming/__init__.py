"""The batch ingest, driven by a file stream."""
