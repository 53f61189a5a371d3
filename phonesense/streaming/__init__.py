"""Structured Streaming ingestion of uploads into the parsed payload table."""

from phonesense.streaming.ingest import payload_stream, read_upload_stream, start_payload_ingest, start_reject_log

__all__ = ["payload_stream", "read_upload_stream", "start_payload_ingest", "start_reject_log"]
