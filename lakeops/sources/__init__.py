"""Batch, stream and generated sources."""
