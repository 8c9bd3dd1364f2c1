"""Structured Streaming: envelope parsing, deduplication, sinks, Silver upsert, Gold refresh."""
