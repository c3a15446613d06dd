"""Incremental ingestion of newly landed files (Structured Streaming)."""

from tenderlake.streaming.landing import contract_stream, ingest_contracts

__all__ = ["contract_stream", "ingest_contracts"]
