from sluice.streaming.loops import ingestion_stream, publication_streams

__all__ = ["ingestion_stream", "publication_streams"]
