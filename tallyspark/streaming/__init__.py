"""Incremental ingestion: the raw → enriched layers over a folder that keeps
receiving order-line files (Structured Streaming)."""

from tallyspark.streaming.ingest import enriched_order_stream, run_available, write_batches

__all__ = ["enriched_order_stream", "run_available", "write_batches"]
