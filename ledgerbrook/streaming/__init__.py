"""New-file ingestion with Structured Streaming."""
