"""Incremental ingestion (Structured Streaming) for the series encoding."""

from hourglass.streaming.micro_batch import encode_ingested, ingest_stream, write_stream_input  # noqa: F401
